"""Prefix trie of conversations by the Euler-tour technique.

A node is a distinct sequence of first turns. The turns of a conversation get their depths, and a prefix its identity, by
running sums over a global order: the 128-bit sum of a hash of each turn with its depth. So neither a very long
conversation nor one with very many copies is collected anywhere. Nodes are then aggregated by identity.

Each node gives two arcs, one that enters it and one that leaves it. The arc after entering is that into the first child,
or out of the node itself; the arc after leaving is that into the next sibling, or out of the parent. The arcs form one list,
whose ranks (``ordered.list_ranks``) are the places of the tour. With the values of the nodes at their entering
arcs, running sums over the places give every subtree's total as a difference: the sum at the leaving arc, less that before
the entering one.

The ids of the conversations that end in a node are joined by blocks of ``BLOCK`` consecutive ids, where they are dealt,
and the blocks of a node are then hashed in order as a stream; only the digest's own chain is sequential.

Defined cases: rows without a conv_id belong to no conversation; null roles and texts are empty ones; rows of a conversation
with the same turn stand in the order of their content's hash, and equal rows are turns one after the other; a conversation
all of whose turns are replaced by those of an empty prefix is a member of the root; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.llm.ordered import list_ranks, running
from tessella.llm.tables import arrow_batches, store

#: Conversations that share a prefix, and turns of it at most.
GROUP, SHARED = 20, 3
BLOCK = 4096
LANES = ("lane0", "lane1", "lane2", "lane3")
ROOT = "0:0:0:0:0"
EMPTY_DIGEST = hashlib.sha256(b"").hexdigest()


def _lanes(digest: Column, depth: Column) -> list[Column]:
    """A 128-bit hash of a turn at a depth, in four parts, whose sums stay in 64 bits for 2**31 turns."""
    out = []
    for seed in (1, 2):
        both = F.xxhash64(F.lit(seed), digest, depth)
        out += [F.shiftrightunsigned(both, 32), both.bitwiseAND(F.lit(0xFFFFFFFF))]
    return [x.cast("long").alias(n) for x, n in zip(out, LANES, strict=True)]


def _identity(depth: Column, sums: list[Column]) -> Column:
    return F.concat_ws(":", depth, *sums)


def turns(rows: DataFrame) -> DataFrame:
    """(conv_id, place, digest, words) of each turn; place from 0 in the order of ``turn``."""
    role, text = F.coalesce(rows["role"].cast("string"), F.lit("")), F.coalesce(rows["text"].cast("string"), F.lit(""))
    content = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    words = F.size(F.array_remove(F.split(text, r"[\x20\x09-\x0D]+", -1), ""))
    own = rows.select(rows["conv_id"].cast("long").alias("conv_id"), rows["turn"].cast("long").alias("turn"), F.sha2(content.cast("binary"), 256).alias("digest"), words.cast("long").alias("words"))
    # equal rows travel as one with their number
    once = own.filter("conv_id IS NOT NULL").groupBy("conv_id", "turn", "digest", "words").agg(F.count(F.lit(1)).alias("copies"))
    placed = running(store(once, "trie-turns"), "conv_id", ["turn", "digest"], ["copies"], "trie-places")
    first = F.col("run_copies") - F.col("copies")
    return placed.select("conv_id", F.explode(F.sequence(first, F.col("run_copies") - 1)).alias("place"), "digest", "words")


def shared_prefixes(own: DataFrame, group: int = GROUP, shared: int = SHARED) -> tuple[DataFrame, DataFrame]:
    """(conversations (conv_id), rebuilt turns (conv_id, depth, digest, words)): the first h turns of each conversation c
    are those of conversation c - c % group, h being crc32(c) % (shared + 1)."""
    sizes = own.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (shared + 1)
    convs = sizes.select("conv_id", "n", h.cast("long").alias("h"), (F.col("conv_id") - F.col("conv_id") % group).alias("base"))
    convs = store(convs, "trie-conversations")
    of_base = convs.select(F.col("conv_id").alias("base"), F.least("n", F.lit(shared)).alias("n_base"))
    convs = convs.join(of_base.hint("merge"), "base", "left").withColumn("taken", F.least("h", F.coalesce("n_base", F.lit(0))))
    convs = store(convs.select("conv_id", "base", "h", "taken"), "trie-conversations")
    heads = own.filter(F.col("place") < shared).withColumnRenamed("conv_id", "base")
    borrowed = convs.filter("taken > 0").join(heads.hint("merge"), "base").filter("place < taken").select("conv_id", (F.col("place") + 1).alias("depth"), "digest", "words")
    # h follows from the id, and most conversations find all h turns: only the others' ids have to be joined
    rest = own.withColumn("h", h.cast("long")).filter("place >= h")
    moved = convs.filter("taken < h").select("conv_id", (F.col("taken") - F.col("h")).alias("shift"))
    rest = rest.join(moved, "conv_id", "left").select("conv_id", (F.col("place") + 1 + F.coalesce("shift", F.lit(0))).alias("depth"), "digest", "words")
    return convs.select("conv_id"), borrowed.union(rest)


def nodes_of(rebuilt: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes (key, depth, conv_id, parent_key, n_convs, words, number), ends (key, conv_id)) of rebuilt turns."""
    named = store(rebuilt.select("conv_id", "depth", "words", *_lanes(F.col("digest"), F.col("depth"))), "trie-rebuilt")
    summed = running(named, "conv_id", ["depth"], list(LANES), "trie-prefixes")
    sums = [F.col(f"run_{x}") for x in LANES]
    before = [F.col(f"run_{x}") - F.col(x) for x in LANES]
    keyed = summed.select("conv_id", "depth", "words", _identity(F.col("depth"), sums).alias("key"), _identity(F.col("depth") - 1, before).alias("parent_key"))
    nodes = keyed.groupBy("key").agg(F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.min("parent_key").alias("parent_key"), F.count(F.lit(1)).alias("n_convs"), F.min("words").alias("words"))
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0")
    root = root.select(F.lit(ROOT).alias("key"), F.lit(0).cast("long").alias("depth"), "conv_id", F.lit(None).cast("string").alias("parent_key"), "n_convs", F.lit(0).cast("long").alias("words"))
    numbered = running(store(nodes.union(root), "trie-nodes"), None, ["conv_id", "depth"], [], "trie-numbers").withColumnRenamed("place", "number")
    last = named.groupBy("conv_id").agg(F.max("depth").alias("depth"), *[F.sum(x).alias(x) for x in LANES])
    at = F.coalesce(_identity(F.col("depth"), [F.col(x) for x in LANES]), F.lit(ROOT))
    ends = convs.join(last.hint("merge"), "conv_id", "left").select(F.when(F.col("depth").isNull(), ROOT).otherwise(at).alias("key"), "conv_id")
    return numbered, ends


def tour(tree: DataFrame) -> DataFrame:
    """(item, next) of the arcs of a tree (number, parent, sibling): node v enters as 2 v and leaves as 2 v + 1.
    ``sibling`` is a child's place among those of its parent."""
    first = tree.filter("sibling = 0 AND parent IS NOT NULL").select(F.col("parent").alias("number"), F.col("number").alias("child"))
    beside = tree.filter("sibling > 0").select("parent", (F.col("sibling") - 1).alias("sibling"), F.col("number").alias("beside"))
    enter = tree.join(first.hint("merge"), "number", "left").select((2 * F.col("number")).alias("item"), F.coalesce(2 * F.col("child"), 2 * F.col("number") + 1).alias("next"))
    leave = tree.join(beside.hint("merge"), ["parent", "sibling"], "left").select((2 * F.col("number") + 1).alias("item"), F.coalesce(2 * F.col("beside"), 2 * F.col("parent") + 1).alias("next"))
    return enter.union(leave)


def subtree_sums(tree: DataFrame, values: list[str]) -> DataFrame:
    """(number, sub_<x>) for a tree (number, parent, sibling, values): each value summed over a node's subtree."""
    ranks = list_ranks(tour(tree), "trie-ranks")
    arcs = ranks.select(F.shiftright("item", 1).alias("number"), (F.col("item") % 2).alias("leaves"), (-F.col("rest")).alias("at"))
    at_enter = [F.when(F.col("leaves") == 0, F.col(x)).otherwise(F.lit(0)).cast("long").alias(x) for x in values]
    valued = arcs.join(tree.select("number", *values).hint("merge"), "number").select("number", "leaves", "at", *at_enter)
    summed = running(store(valued, "trie-tour"), None, ["at"], values, "trie-sums")
    out = [F.sum(F.when(F.col("leaves") == 1, F.col(f"run_{x}")).otherwise(F.col(x) - F.col(f"run_{x}"))).alias(f"sub_{x}") for x in values]
    return summed.groupBy("number").agg(*out)


def digests(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256) of rows (key, conv_id): the ids in numerical order, joined by commas."""
    blocks = ends.groupBy("key", F.floor(F.col("conv_id") / BLOCK).alias("block")).agg(F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            found: list[tuple[str, str]] = []
            for own, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if own != key:
                    if key is not None:
                        found.append((key, state.hexdigest()))
                    key, state = own, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in found]), pa.array([d for _, d in found])], ["key", "ends_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([state.hexdigest()])], ["key", "ends_sha256"])

    arrow_batches(ends.sparkSession, 200)
    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    in_order = blocks.repartition(parts, "key").sortWithinPartitions("key", "block")
    return in_order.select("key", "ids").mapInArrow(work, "key string, ends_sha256 string")


def trie(rows: DataFrame, group: int = GROUP, shared: int = SHARED) -> DataFrame:
    """One row for each node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    convs, rebuilt = shared_prefixes(store(turns(rows), "trie-turns"), group, shared)
    numbered, ends = nodes_of(rebuilt, convs)
    parents = numbered.select(F.col("key").alias("parent_key"), F.col("number").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    linked = store(numbered.join(parents.hint("merge"), "parent_key", "left").select("key", "number", "depth", "conv_id", "n_convs", "words", F.coalesce("parent", F.lit(-1).cast("long")).alias("parent"), "parent_conv_id"), "trie-links")
    beside = running(linked.select("number", "parent"), "parent", ["number"], [], "trie-siblings").withColumnRenamed("place", "sibling")
    children = beside.groupBy(F.col("parent").alias("number")).agg(F.count(F.lit(1)).alias("n_children"))
    valued = linked.select("number", "n_convs", "words").join(children.hint("merge"), "number", "left")
    valued = valued.select("number", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    tree = beside.join(valued.hint("merge"), "number").withColumn("leaf", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long"))
    tree = store(tree.withColumn("parent", F.when(F.col("parent") >= 0, F.col("parent"))), "trie-tree")
    totals = subtree_sums(tree.select("number", "parent", "sibling", "leaf", "saved"), ["leaf", "saved"])
    out = linked.drop("parent", "words").join(totals.hint("merge"), "number").join(tree.select("number", "n_children").hint("merge"), "number")
    out = out.join(digests(ends).hint("merge"), "key", "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("sub_leaf").alias("n_leaves"), F.col("sub_saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(EMPTY_DIGEST)).alias("ends_sha256"))
