"""Artefact files and snapshots: code, labels and requests, one row per artefact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tessella.functions.text import GENERATOR_ENDING, as_col, base_name, split_ext
from tessella.sources.listing import read_files

# File extension -> artefact kind.
KINDS = {".swift": "code", ".json": "label", ".txt": "prompt"}

KEYS = ("generator", "base_filename", "kind")
#: What a snapshot is stored by.
PARTITIONS = ("generator", "kind")


def parse_artifact_path(path: Column | str) -> Column:
    """``struct(folder, base_filename, ext, kind, polarity, generator)``. ``folder`` is the last folder of
    the path: the generator's or the project's; ``generator`` is its name without the ending that
    ``manifest.artifact_paths`` gives it."""
    p = as_col(path)
    parts = split_ext(base_name(p))
    kind = F.lit(None).cast("string")
    for ext, name in KINDS.items():
        kind = F.when(parts["ext"] == ext, name).otherwise(kind)
    folder = F.regexp_extract(p, r"([^/]*)/[^/]*\z", 1)
    return F.struct(
        folder.alias("folder"),
        parts["stem"].alias("base_filename"),
        parts["ext"].alias("ext"),
        kind.alias("kind"),
        F.nullif(F.regexp_extract(parts["stem"], r"_(positive|negative)\z", 1), F.lit("")).alias("polarity"),
        F.regexp_replace(folder, f"{GENERATOR_ENDING}\\z", "").alias("generator"),
    )


def read_artifacts(spark: SparkSession, root: str, glob: str = "*", recursive: bool = True) -> DataFrame:
    """(folder, base_filename, ext, kind, polarity, generator, content, n_bytes, path), one row per file whose
    name matches; content that is not UTF-8 is null, that of a file without bytes is empty. Folders are listed and
    read by tasks; compact many small files with ``write_snapshot`` before reading them more than once."""
    files = read_files(spark, root, glob, recursive)
    content = F.try_validate_utf8(F.col("content").cast("string")).alias("content")
    return files.select(F.inline(F.array(parse_artifact_path("path"))), content, F.col("length").alias("n_bytes"), "path")


def projects(artifacts: DataFrame) -> DataFrame:
    return artifacts.select("project").distinct()


def order_projects(df: DataFrame, priority: list[str] = ()) -> DataFrame:
    """Projects named in ``priority`` first and in that order, the rest by name."""
    place = F.array_position(F.lit(list(priority)), F.col("project")) if priority else F.lit(0)
    ranked = df.withColumn("priority", F.nullif(place.cast("bigint"), F.lit(0)))
    return ranked.orderBy(F.asc_nulls_last("priority"), "project")


def discover_sources(artifacts: DataFrame, known: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(code artefacts, code files per project). Projects without code count zero, and so do those of
    ``known`` (project) without any artefact."""
    code = F.col("kind") == "code"
    tasks = artifacts.where(code).select("project", "base_filename")
    flags = artifacts.select("project", code.alias("is_code"))
    if known is not None:
        flags = flags.unionByName(known.select("project", F.lit(False).alias("is_code")))
    return tasks, flags.groupBy("project").agg(F.count_if("is_code").alias("n_code"))


def upsert(existing: DataFrame, updates: DataFrame, keys=KEYS, order: str | None = None) -> DataFrame:
    """Updates replace existing artefacts of the same key. Of several updates of one key the last by the
    column ``order`` counts; without an order they are an error."""
    keys = list(keys)
    if order is None:
        number = updates.groupBy(*keys).agg(F.count("*").alias("_n"))
        single = F.assert_true(F.col("_n") == 1, F.lit("several updates of one key; name a column to order them by"))
        updates = updates.join(number, keys).where(single.isNull()).select(*updates.columns)
    else:
        last = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(order)))
        updates = updates.withColumn("_last", last).where("_last = 1").drop("_last")
    # only rows of a generator and kind that has updates are looked up by their keys; all others stay where they are read
    parts = [k for k in PARTITIONS if k in keys]
    if not parts:
        return existing.join(updates.select(*keys), keys, "left_anti").unionByName(updates.select(*existing.columns))
    touched = F.broadcast(updates.select(*parts).distinct())
    untouched = existing.join(touched, parts, "left_anti")
    kept = existing.join(touched, parts, "left_semi").join(updates.select(*keys), keys, "left_anti")
    return untouched.unionByName(kept).select(*existing.columns).unionByName(updates.select(*existing.columns))


def write_snapshot(artifacts: DataFrame, path: str) -> None:
    """Parquet by generator and kind; partitions that get no rows stay as they are. Write an
    ``upsert`` to a new path, or the touched partitions only: a path cannot be read and
    overwritten at once."""
    (
        artifacts.hint("rebalance", *PARTITIONS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(*PARTITIONS)
        .parquet(path)
    )
