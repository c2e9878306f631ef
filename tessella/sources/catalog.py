"""Pattern catalogs: JSON files mapping a category to its list of pattern texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessella.functions.labels import is_strict_json
from tessella.operators.manifest import index_patterns
from tessella.session import prepare


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """(category, cat_pos, idx, text, ...): one row per pattern; ``cat_pos`` orders the categories by file and
    by place in it, and ``idx`` counts from 1. A catalog file is one JSON value, so one row; a folder of
    catalog files is read in parallel.

    A file must be one strict JSON object, else reading it fails. Of a category that a file names twice the last
    list counts, in the first place.
    """
    files = prepare(spark).read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"),
        F.when(is_strict_json("value"), F.from_json("value", "map<string,array<string>>", {"mode": "FAILFAST"}))
        .otherwise(F.raise_error(F.concat(F.lit("not a strict JSON catalog: "), "_metadata.file_path")))
        .alias("m"),
    )
    named = (
        files.select("file", F.posexplode(F.map_entries("m")).alias("at", "e"))
        .groupBy("file", F.col("e.key").alias("category"))
        .agg(F.min("at").alias("at"), F.max_by("e.value", "at").alias("texts"))
    )
    return index_patterns(
        named.select("category", F.struct("file", "at").alias("cat_pos"), F.posexplode("texts").alias("pos", "text"))
        .select("category", "cat_pos", (F.col("pos") + 1).alias("idx"), "text")
    )
