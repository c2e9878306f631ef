"""Finding and removing contradictory or unwanted artefacts. Removal gives a new snapshot; nothing
is deleted in place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tessella.functions import labels
from tessella.functions.text import let

KEYS = ("generator", "base_filename", "kind")


def has_polarity(polarity: str, name: str = "base_filename") -> Column:
    return F.endswith(name, F.lit("_" + polarity))


def audit_positive(artifacts: DataFrame) -> DataFrame:
    """Labels of positive samples with ``flagged``: the identifier list is there and empty. Labels
    that do not parse are scanned but not flagged."""
    empty = let(
        labels.strict_variant("content"), lambda v: F.coalesce(F.size(labels.label_items(v)) == 0, F.lit(False))
    )
    return artifacts.where((F.col("kind") == "label") & has_polarity("positive")).select(
        *KEYS, empty.alias("flagged")
    )


def flagged(artifacts: DataFrame) -> DataFrame:
    return audit_positive(artifacts).where("flagged").select(*KEYS)


def audit_summary(artifacts: DataFrame) -> DataFrame:
    """(generator, scanned, flagged); the row without a generator is the total."""
    return (
        audit_positive(artifacts)
        .rollup("generator")
        .agg(F.count("*").alias("scanned"), F.count_if("flagged").alias("flagged"))
    )


def select_negative(artifacts: DataFrame, generator: str | None = None) -> DataFrame:
    """Keys of all artefacts of negative samples. With artefacts stored by generator, naming one
    reads only its folder."""
    found = artifacts.where(has_polarity("negative") | F.contains("base_filename", F.lit("_negative.")))
    if generator is not None:
        found = found.where(F.col("generator") == generator)
    return found.select(*KEYS)


def prune(artifacts: DataFrame, selection: DataFrame) -> DataFrame:
    """The snapshot without the selected artefacts. Pruning a label keeps its code, so the sample
    is labelled anew."""
    return artifacts.join(selection, list(KEYS), "left_anti")


def remove(artifacts: DataFrame, selection: DataFrame, dry_run: bool = True) -> DataFrame:
    """A dry run shows the selected artefacts; otherwise the snapshot without them."""
    return artifacts.join(selection, list(KEYS), "left_semi") if dry_run else prune(artifacts, selection)


def removal_counts(artifacts: DataFrame, selection: DataFrame) -> DataFrame:
    """(deleted, failed): selected keys that exist, and those that do not."""
    present = artifacts.select(*KEYS).distinct().withColumn("present", F.lit(True))
    return (
        selection.select(*KEYS)
        .distinct()
        .join(present, list(KEYS), "left")
        .agg(F.count_if("present").alias("deleted"), F.count_if(F.col("present").isNull()).alias("failed"))
    )
