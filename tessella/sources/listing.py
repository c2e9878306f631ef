"""Files as rows, listed, read and written where Spark runs its tasks.

A Python data source whose partitions are sets of folders: the driver looks at folder names only, level by level, until
there are enough of them, and each task walks its own folders. So neither the paths nor the contents of many small files pass
through the driver, and files without bytes are rows like all others.

Files are written by the tasks that hold their rows: each file is put in its place by a rename when it is whole, and nothing
is left to the driver for each of them. A task that runs again writes the same files.

Defined cases: rows of one path make one file, one behind the other; names that begin with ``_`` or ``.`` are left out, as Spark does; a root without files gives no rows; a file
that goes while its folder is read is left out. Local paths and all stores that Arrow can open are read.
"""

from __future__ import annotations

import fnmatch
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

#: Folders from which no further level is split up, and partitions at most.
ENOUGH_FOLDERS = 256
#: Bytes of content passed on at a time.
BATCH_BYTES = 8 << 20
SCHEMA = "path string, length bigint, content binary"


def _opened(root: str) -> tuple[pafs.FileSystem, str, str]:
    """(file system, path in it, what to put before such a path)."""
    scheme, colon, rest = root.partition(":")
    if not colon or "/" in scheme:
        return pafs.LocalFileSystem(), root, "file:"
    if scheme == "file":
        return pafs.LocalFileSystem(), "/" + rest.lstrip("/"), "file:"
    store, path = pafs.FileSystem.from_uri(root)
    return store, path, root[: root.index(path)] if path in root else f"{scheme}:"


def _shown(info: pafs.FileInfo) -> bool:
    return info.base_name[:1] not in ("_", ".")


class _Folders(InputPartition):
    def __init__(self, own: list[str], deep: list[str]):
        self.own, self.deep = own, deep


class _FileReader(DataSourceReader):
    def __init__(self, options: dict):
        self.root = options["path"]
        self.glob = options.get("glob", "*")
        self.recursive = str(options.get("recursive", "true")).lower() == "true"

    def partitions(self) -> list[_Folders]:
        store, root, _ = _opened(self.root)
        done, open_ = [], [root]
        while self.recursive and open_ and len(done) + len(open_) < ENOUGH_FOLDERS:
            done += open_
            below = (i for path in open_ for i in store.get_file_info(pafs.FileSelector(path)))
            open_ = [i.path for i in below if i.type == pafs.FileType.Directory and _shown(i)]
        # those looked into give their own files, the others all that is below them
        own, deep = (done, open_) if self.recursive else ([root], [])
        n = min(max(len(own), len(deep)), ENOUGH_FOLDERS)
        return [_Folders(own[k::n], deep[k::n]) for k in range(n)]

    def read(self, partition: _Folders) -> Iterator[pa.RecordBatch]:
        store, _, prefix = _opened(self.root)
        rows, size = [], 0
        folders = [(p, False) for p in partition.own] + [(p, True) for p in partition.deep]
        while folders:
            folder, deep = folders.pop()
            for info in store.get_file_info(pafs.FileSelector(folder)):
                if not _shown(info):
                    continue
                if info.type == pafs.FileType.Directory and deep:
                    folders.append((info.path, True))
                if info.type != pafs.FileType.File or not fnmatch.fnmatchcase(info.base_name, self.glob):
                    continue
                try:
                    with store.open_input_stream(info.path, compression=None) as stream:
                        content = stream.read()
                except FileNotFoundError:
                    continue
                rows.append((prefix + info.path, len(content), content))
                size += len(content)
                if size > BATCH_BYTES or len(rows) >= 10_000:
                    yield _batch(rows)
                    rows, size = [], 0
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple[str, int, bytes]]) -> pa.RecordBatch:
    path, length, content = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(path), pa.array(length, pa.int64()), pa.array(content, pa.binary())], ["path", "length", "content"])


class _FileWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.root = options["path"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        store, root, _ = _opened(self.root)
        attempt = TaskContext.get().taskAttemptId()
        stream = unplaced = current = None

        def place() -> None:
            if stream is not None:
                stream.close()
                store.move(unplaced, f"{root}/{current}")

        for batch in iterator:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if path != current:
                    place()
                    folder, _, name = f"{root}/{path}".rpartition("/")
                    store.create_dir(folder, recursive=True)
                    current, unplaced = path, f"{folder}/_{attempt}.{name}"
                    stream = store.open_output_stream(unplaced, compression=None)
                stream.write(content)
        place()
        return WriterCommitMessage()


class FileSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "whole_files"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _FileReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _FileWriter(dict(self.options))


def read_files(spark: SparkSession, root: str, glob: str = "*", recursive: bool = True) -> DataFrame:
    """(path, length, content), one row for each file whose name matches."""
    spark.dataSource.register(FileSource)
    return spark.read.format("whole_files").option("glob", glob).option("recursive", str(recursive).lower()).load(root)


def partition_text(value: Column | str) -> Column:
    """A value as it stands in the name of a partition's folder, as Spark writes it."""
    named = F.col(value) if isinstance(value, str) else value
    text = F.replace(named, F.lit("%"), F.lit("%25"))
    for code in [*range(1, 32), *map(ord, "\"#'*/:=?\\{[]^"), 127]:
        text = F.replace(text, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return F.coalesce(F.nullif(text, F.lit("")), F.lit("__HIVE_DEFAULT_PARTITION__"))


def write_files(rows: DataFrame, root: str) -> None:
    """Write (path under ``root``, content) as files, the rows of a path into one file."""
    spark = rows.sparkSession
    spark.dataSource.register(FileSource)
    tasks = max(16, 4 * spark.sparkContext.defaultParallelism)
    ordered = rows.select("path", "content").repartition(tasks, "path").sortWithinPartitions("path")
    ordered.write.format("whole_files").mode("append").save(root)
