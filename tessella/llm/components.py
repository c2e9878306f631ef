"""Connected components of a graph of links, by star contraction on DataFrames.

Two steps take turns until nothing changes: each node points its larger neighbours to its smallest one, then its smaller
neighbours and itself to the smallest of those. The graph becomes one star per component in a number of rounds that
grows with the logarithm of its size. Every round is written to the shared folder, so lineage stays short and a lost
executor costs a re-read. Only two numbers a round reach the driver.

Defined cases: links of a node to itself and repeated links are ignored; nulls are dropped; no links give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.tables import store


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large(links: DataFrame) -> DataFrame:
    around = _both_ways(links)
    least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return around.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small(links: DataFrame) -> DataFrame:
    # u > v in every link here
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").filter("v <> m").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, label) of every node in links (a, b): the label is the smallest node of its component."""
    links = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    links, last = store(links, name), None
    while True:
        links = store(_small(_large(links)), name)
        now = tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == last or not now[0]:
            break
        last = now
    roots = links.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("label"))
    return links.select(F.col("u").alias("node"), F.col("v").alias("label")).union(roots)
