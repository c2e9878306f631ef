"""Places and running sums of rows in a global order, and ranks of linked lists: none of them needs a group, or the
whole table, in one task.

Rows are dealt into ranges of the order, at most ``MOST_PARTS`` of them; each range is sorted and read as a stream that
carries its sums from batch to batch; what lies in front of a range, of a group that began in an earlier one, is added
afterwards. So a group that holds a third of all rows spans a third of the ranges.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tessella.llm.tables import arrow_batches, store

#: Rows of a range, until there are as many ranges as allowed; then ranges grow, sorted on disk where memory ends.
RANGE_ROWS = 1 << 15
#: Ranges, and so rows of the table of what lies in front of them, at most.
MOST_PARTS = 1 << 14
#: One in so many items of a list is a ruler.
STRIDE = 32
#: A list of at most so many items is ranked by one task.
SMALL = 1 << 14


def running(df: DataFrame, group: str | None, order: list[str], sums: list[str], name: str) -> DataFrame:
    """df with ``place``, the number of rows before a row in its group (a column of longs without nulls; None: all rows
    are one group), and ``run_<x>``, the sum of x over these rows and the row, for each of ``sums`` (longs, no nulls).

    The order must tell all rows of a group apart, or the rows that it does not are dealt to one range. df should
    be cheap to read twice, so a stored table."""
    spark = df.sparkSession
    parts = max(1, min(MOST_PARTS, math.ceil(df.count() / RANGE_ROWS)))
    keys = ([group] if group else []) + order
    dealt = df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys) if parts > 1 else df.coalesce(1).sortWithinPartitions(*keys)
    dealt = dealt.withColumn("part", F.spark_partition_id().cast("long"))
    fresh = ["place", *[f"run_{s}" for s in sums]]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema] + [f"`{c}` long" for c in fresh])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, carried = None, np.zeros(1 + len(sums), np.int64)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            own = batch.column(batch.schema.get_field_index(group)).to_numpy() if group else np.zeros(n, np.int64)
            new = np.flatnonzero(np.diff(own, prepend=own[0] - 1 if last is None or own[0] != last else own[0]) != 0)
            values = [np.ones(n, np.int64), *[batch.column(batch.schema.get_field_index(s)).to_numpy() for s in sums]]
            out = []
            for k, x in enumerate(values):
                total = np.cumsum(x) + carried[k]
                before = np.zeros(len(new) + 1, np.int64)  # what each group of the batch starts with
                before[1:] = np.where(new > 0, total[new - 1], carried[k])
                at = np.searchsorted(new, np.arange(n), "right")
                total = total - before[at]
                carried[k] = total[-1]
                out.append(total - 1 if k == 0 else total)
            last = own[-1]
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(x, pa.int64()) for x in out]], [*batch.schema.names, *fresh])

    arrow_batches(spark, 20_000)
    ranked = store(dealt.mapInArrow(work, schema), name)
    if parts == 1:
        return ranked.drop("part")
    return _from_the_front(ranked, group, sums).drop("part")


def _from_the_front(ranked: DataFrame, group: str | None, sums: list[str]) -> DataFrame:
    """``ranked`` with what earlier ranges hold of a row's group added."""
    fresh = ["place", *[f"run_{s}" for s in sums]]
    own = F.col(group) if group else F.lit(0).cast("long")
    edges = ranked.groupBy("part").agg(F.min(own).alias("low"), F.max(own).alias("high"))
    # a group that spans ranges is the last of one and the first of another: at most two rows a range
    totals = ranked.join(F.broadcast(edges), "part").filter((own == F.col("low")) | (own == F.col("high")))
    totals = totals.groupBy("part", own.alias("group")).agg(F.count(F.lit(1)).alias("place"), *[F.sum(s).alias(f"run_{s}") for s in sums])
    before = Window.partitionBy("group").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("part").alias("at_part"), F.col("group").alias("at_group"), *[F.sum(c).over(before).alias(f"front_{c}") for c in fresh])
    offsets = offsets.filter("front_place IS NOT NULL")  # at most one row a range
    joined = ranked.join(F.broadcast(offsets), (F.col("part") == F.col("at_part")) & (own == F.col("at_group")), "left")
    added = {c: F.col(c) + F.coalesce(F.col(f"front_{c}"), F.lit(0)) for c in fresh}
    return joined.select(*[added.get(c, F.col(c)).alias(c) for c in ranked.columns])


def list_ranks(links: DataFrame, name: str = "ranks") -> DataFrame:
    """(item, rest) of the items of linked lists (item long, next long or null): the number of items after it.

    One in ``STRIDE`` items, by a hash, is a ruler. Every item jumps: it takes over its successor's pointer, so what it has
    passed doubles with each jump, until it points to a ruler or to the end. The rulers then are a list of their own,
    with known distances, ranked the same way, and an item's rank is its ruler's plus the way to it. Items that have
    arrived are written once and no longer jump, so rounds shrink; the number of rounds is the logarithm of the
    longest stretch without a ruler. Each round is written to the shared folder.
    """
    return _ranks(store(links.select("item", "next", F.lit(1).cast("long").alias("way")), name), name, 0)


def _ranks(links: DataFrame, name: str, depth: int) -> DataFrame:
    """(item, rest) for (item, next, way), the way being that from an item to the next one, or for a
    last one the number of items from it to the end."""
    if links.count() <= SMALL:
        arrow_batches(links.sparkSession, 10_000)
        return links.groupBy(F.lit(0).alias("all")).applyInArrow(_walk, "item long, rest long")
    is_ruler = lambda c: F.pmod(F.xxhash64(c, F.lit(depth)), F.lit(STRIDE)) == 0
    state = links.select("item", F.col("next").alias("to"), "way")
    arrived: Column = F.col("to").isNull() | is_ruler(F.col("to"))
    done, active = [state.filter(arrived)], state.filter(~arrived)
    while True:
        around = active
        for part in done:
            around = around.union(part)
        # what an active item points to is no ruler
        target = around.filter(~is_ruler(F.col("item"))).select(F.col("item").alias("to"), F.col("to").alias("next"), F.col("way").alias("more"))
        jumped = store(active.join(target.hint("merge"), "to").select("item", F.col("next").alias("to"), (F.col("way") + F.col("more")).alias("way")), name)
        done.append(jumped.filter(arrived))
        active = jumped.filter(~arrived)
        if active.isEmpty():
            break
    state = done[0]
    for part in done[1:]:
        state = state.union(part)
    rulers = state.filter(is_ruler(F.col("item"))).select("item", F.col("to").alias("next"), "way")
    ranks = _ranks(store(rulers, name), name, depth + 1).select(F.col("item").alias("to"), F.col("rest").alias("beyond"))
    found = state.join(ranks, "to", "left")
    return store(found.select("item", (F.col("way") - F.when(F.col("to").isNull(), 1).otherwise(0) + F.coalesce("beyond", F.lit(0))).alias("rest")), name)


def _walk(table: pa.Table) -> pa.Table:
    """Ranks of a short list, by jumps within arrays."""
    item, way = table["item"].to_numpy(), table["way"].to_numpy().copy()
    order = np.argsort(item)
    ends = len(item)  # a last place that stands for the end
    to = np.append(_index(item[order], table["next"])[order], ends)
    way = np.append(way[order], 0)
    way[:-1][to[:-1] == ends] -= 1  # nothing stands behind the last item
    while (to != ends).any():
        way, to = way + way[to], to[to]
    return pa.table({"item": pa.array(item[order], pa.int64()), "rest": pa.array(way[:-1], pa.int64())})


def _index(ordered: np.ndarray, wanted: pa.ChunkedArray) -> np.ndarray:
    """Where each wanted item stands; behind the last for null."""
    none = wanted.is_null().to_numpy()
    return np.where(none, len(ordered), np.searchsorted(ordered, wanted.fill_null(0).to_numpy()))
