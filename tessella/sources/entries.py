"""JSONL datasets: reading with bad-line accounting, selecting, combining, writing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tessella.functions.labels import is_too_large, strict_variant
from tessella.functions.text import base_name, computed_once, let, split_ext, strip
from tessella.session import prepare

FIELDS = ("instruction", "input", "output")


def parse_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """Adds instruction, input, output and ``reject`` to every non-blank line.

    ``reject`` is null for entries, else ``not_json``, ``too_large`` (not read for its depth or size),
    ``not_object`` or ``output_not_text``. A
    missing output is no reject; the entry then counts as one with an invalid output.
    """
    keep = [c for c in lines.columns if c != line]

    def fields(text, v):
        kind = F.schema_of_variant(F.try_variant_get(v, "$[0].output", "variant"))
        is_object = F.startswith(F.schema_of_variant(F.try_variant_get(v, "$[0]", "variant")), F.lit("OBJECT"))
        return F.struct(
            text.alias(line),
            *[F.try_variant_get(v, f"$[0].{name}", "string").alias(name) for name in FIELDS],
            F.when(v.isNull(), F.when(is_too_large(text), "too_large").otherwise("not_json"))
            .when(~is_object, "not_object")
            .when(kind.isNotNull() & (kind != "STRING"), "output_not_text")
            .alias("reject"),
        )

    parts = let(strip(line), lambda text: let(strict_variant(text), lambda v: fields(text, v)))
    return lines.select(*keep, computed_once(parts)).where(F.col(line) != "")


def split_lines(parsed: DataFrame, line: str = "line") -> tuple[DataFrame, DataFrame]:
    """(entries, rejects) of ``parse_lines``."""
    rejects = parsed.where(F.col("reject").isNotNull()).drop(*FIELDS)
    return parsed.where(F.col("reject").isNull()).drop("reject", line), rejects


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(dataset, file, block, row, line): (block, row) ascends in file order.

    The dataset is the ``dataset=`` folder that the file lies in, as ``write_entries`` lays them out, else the
    file's stem. ``block`` is the byte offset of the input split and ``row`` ascends within a split, so lines
    are ordered without a sort or a shuffle.
    """
    folder = F.nullif(F.regexp_extract("_metadata.file_path", r"/dataset=([^/]+)/[^/]*\z", 1), F.lit(""))
    # the folder's name is escaped, and so is the path as a whole; a plus sign stands for itself
    decode = lambda c: F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)
    name = decode(decode(folder))
    return spark.read.text(path, recursiveFileLookup=True).select(
        F.coalesce(name, split_ext(base_name("_metadata.file_path"))["stem"]).alias("dataset"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        F.col("value").alias("line"),
    )


def read_entries(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(entries, rejects) of a JSONL file or folder. ``entry_id`` is ``struct(file, block, row)``: it
    orders the entries of a dataset; ``number_entries`` turns it into a contiguous index."""
    parsed = parse_lines(read_lines(prepare(spark), path))
    return tuple(
        df.withColumn("entry_id", F.struct("file", "block", "row")).drop("block", "row") for df in split_lines(parsed)
    )


def reject_sample(rejects: DataFrame, n: int = 5) -> DataFrame:
    """The first n rejects, as a report shows them."""
    return rejects.orderBy("file", "entry_id").limit(n)


def number_entries(entries: DataFrame, by: str = "file") -> DataFrame:
    """Replace ``entry_id`` by the entry's 0-based position in its file or dataset.

    Entries are ranked within their input split, and splits are offset by the running count of
    one row per split, so no task holds a whole file. Number the narrow rows of ``parse_outputs``
    (``by="dataset"``) rather than whole entries, and no text is shuffled.
    """
    # of its own names, so that entries may have columns called alike
    splits = [F.col(f"entry_id.{x}").alias(f"_{x}") for x in ("file", "block")]
    offsets = (
        entries.groupBy(by, *splits)
        .agg(F.count("*").alias("_n"))
        .withColumn("_before", F.sum("_n").over(Window.partitionBy(by).orderBy("_file", "_block")) - F.col("_n"))
        .drop("_n")
    )
    split = Window.partitionBy(by, "_file", "_block").orderBy("entry_id.row")
    ranked = entries.select("*", *splits).withColumn("_rank", F.row_number().over(split) - 1)
    return (
        ranked.join(offsets, [by, "_file", "_block"])
        .withColumn("entry_id", (F.col("_before") + F.col("_rank")).cast("bigint"))
        .select(*entries.columns)
    )


def select_datasets(
    entries: DataFrame, names: list[str] | None = None, known: list[str] = (), default: str | None = None
) -> DataFrame:
    """Entries of the named datasets, else of all known ones, else of the default one. Names that
    do not occur simply contribute nothing."""
    wanted = list(names) if names else list(known) if known else [default]
    return entries.where(F.col("dataset").isin(wanted))


def combine(datasets: dict[str, DataFrame], name: str = "combined") -> DataFrame:
    """Bag union of datasets under one name; ``part`` keeps where a row came from."""
    tagged = [df.withColumn("part", F.lit(part)).withColumn("dataset", F.lit(name)) for part, df in datasets.items()]
    return reduce(DataFrame.unionByName, tagged)


def write_entries(entries: DataFrame, path: str, by: str = "dataset", max_rows_per_file: int = 0) -> None:
    """JSONL under ``path``, one folder per value of ``by``; UTF-8 as is, absent values get none.

    The rebalance hint evens out output files: adaptive execution splits a large dataset over
    many tasks and merges small ones.
    """
    (
        entries.select(by, *FIELDS)
        .hint("rebalance", by)
        .write.option("maxRecordsPerFile", max_rows_per_file)
        .partitionBy(by)
        .json(path)
    )


def write_project_entries(entries: DataFrame, path: str, all_path: str) -> None:
    """One folder per project and one with all entries; an empty input leaves empty folders."""
    write_entries(entries, path, by="project")
    schema = ", ".join(f"{f} string" for f in FIELDS)
    entries.sparkSession.read.schema(schema).json(path).select(*FIELDS).write.json(all_path)  # not assembled twice


def write_report(report: DataFrame, path: str, tables: dict[str, DataFrame] | None = None) -> None:
    """One JSON object per dataset, plus the tables that grow with the data."""
    report.select(F.to_json(F.struct("*")).alias("value")).write.text(f"{path}/datasets")
    for name, df in (tables or {}).items():
        df.write.json(f"{path}/{name}")
