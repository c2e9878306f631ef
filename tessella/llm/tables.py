"""Small helpers shared by the corpus operators: inputs, batches, shared folders."""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessella.session import scratch_path

#: Bytes of text that one vectorised step takes at a time.
CHUNK_BYTES = 1 << 21


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: Column | str = "text") -> Column:
    """The text with null read as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def arrow_batches(spark: SparkSession, rows: int = 1000, size: str = "8m") -> None:
    """Keep the batches that go to Python small, so that long texts do not add up in a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)
    # workers find the package where the driver found it, whatever folder the driver was started in
    environment, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def store(df: DataFrame, name: str) -> DataFrame:
    """Write to a new folder below ``spark.checkpoint.dir`` and read it back: later steps, retries and
    lost executors read the files again instead of computing them again."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold(column: Column | str, parts: int) -> Column:
    """crc32 of the key as text, modulo ``parts``: how rows are split into learned and held out. A null key
    is in fold 0."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % parts, F.lit(0))


def texts_of(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    """The text column with nulls as empty texts, as plain strings."""
    column = batch.column(batch.schema.get_field_index(name))
    return column.fill_null("") if column.null_count else column


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an array of strings, without a copy; ``offsets`` start at 0."""
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    buffers = texts.buffers()
    if len(texts) == 0 or buffers[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    offsets = np.frombuffer(buffers[1], width)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return np.frombuffer(buffers[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of texts, each of at most ``limit`` bytes or a single text."""
    low, last = 0, len(offsets) - 1
    while low < last:
        high = int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1
        high = min(max(high, low + 1), last)
        yield low, high
        low = high


def fresh(name: str, taken: list[str]) -> str:
    """``name``, with underscores before it until no column is called so."""
    taken = {x.lower() for x in taken}
    while name.lower() in taken:
        name = "_" + name
    return name


def per_batch(work: Callable[[pa.RecordBatch], pa.RecordBatch | None]) -> Callable:
    """A function for mapInArrow from one that takes a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := work(batch)) is not None:
                yield out

    return run


def map_batches(df: DataFrame, work: Callable, schema: str | StructType, rows: int = 1000) -> DataFrame:
    arrow_batches(df.sparkSession, rows)
    return df.mapInArrow(per_batch(work), schema)


def crc(data: bytes) -> int:
    return zlib.crc32(data)


def public_tokenizer(name: str) -> str:
    """Path of a public tokenizer file: ``TESSELLA_TOKENIZERS`` names the folder, else the installed package."""
    folder = os.environ.get("TESSELLA_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)
