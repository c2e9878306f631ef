"""Dataset statistics that merge: a lot of entries is read once, into sketches, and lots are put together without them.

A lot gives one row per dataset: counts, a distinct-count sketch of its identifiers, quantile sketches of list and reasoning
lengths, and a table of frequent identifiers. Rows of a few kilobytes are stored in place of the entries; merging them
gives the sketches of all lots together, in any order and grouping.

Errors, as Spark's sketches have them: about 1.6 % of a distinct count (``LOG_REGISTERS`` 12, one standard error), 1.3 %
of rank for a quantile (``QUANTILE_SIZE`` 200), and for a frequent identifier at most the number of uses divided by about
a third of ``TRACKED``; below these sizes results are exact.

Defined cases: a lot without valid outputs has empty sketches, whose estimates are null or 0; no lots give no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

LOG_REGISTERS = 12
QUANTILE_SIZE = 200
TRACKED = 4096


def lot_sketches(parsed: DataFrame) -> DataFrame:
    """One row per dataset of ``analytics.parse_outputs``. Entries are counted where they are read, and their identifiers
    beside them, so neither meets the other."""
    vulnerable = F.col("category") == "vulnerable"
    own = parsed.groupBy("dataset").agg(
        F.count("*").alias("total"),
        F.count_if("valid").alias("valid"),
        F.kll_sketch_agg_bigint(F.when(vulnerable, F.col("n_items")), QUANTILE_SIZE).alias("items"),
        F.kll_sketch_agg_bigint("reasoning_len", QUANTILE_SIZE).alias("reasoning"),
    )
    uses = parsed.select("dataset", F.explode("items").alias("identifier")).where("identifier is not null")
    named = uses.groupBy("dataset").agg(
        F.count("*").alias("instances"),
        F.hll_sketch_agg("identifier", LOG_REGISTERS).alias("identifiers"),
        F.expr(f"approx_top_k_accumulate(identifier, {TRACKED})").alias("frequent"),
    )
    return own.join(named, "dataset", "left")


def merged(lots: list[DataFrame]) -> DataFrame:
    """The sketches of all lots, one row per dataset."""
    rows = reduce(DataFrame.unionByName, lots)
    whole = rows.groupBy("dataset").agg(
        *[F.sum(c).alias(c) for c in ("total", "valid", "instances")],
        *[F.kll_merge_agg_bigint(c, QUANTILE_SIZE).alias(c) for c in ("items", "reasoning")],
    )
    named = rows.where("frequent is not null").groupBy("dataset").agg(
        F.hll_union_agg("identifiers").alias("identifiers"),
        F.expr(f"approx_top_k_combine(frequent, {TRACKED})").alias("frequent"),
    )
    return whole.join(named, "dataset", "left")


def estimates(sketches: DataFrame, k: int = 15) -> DataFrame:
    """dataset, total, valid, instances, unique_ids, median_items, median_reasoning and top (identifier, n)."""

    def median(name):
        some = F.kll_sketch_get_n_bigint(name) > 0
        return F.when(some, F.kll_sketch_get_quantile_bigint(name, F.lit(0.5)))

    return sketches.select(
        "dataset",
        "total",
        "valid",
        F.coalesce("instances", F.lit(0)).cast("bigint").alias("instances"),
        F.coalesce(F.hll_sketch_estimate("identifiers"), F.lit(0)).cast("bigint").alias("unique_ids"),
        median("items").alias("median_items"),
        median("reasoning").alias("median_reasoning"),
        F.transform(F.when(F.col("frequent").isNotNull(), F.expr(f"approx_top_k_estimate(frequent, {k})")), lambda r: F.struct(r["item"].alias("identifier"), r["count"].alias("n"))).alias("top"),
    )
