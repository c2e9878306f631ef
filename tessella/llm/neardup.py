"""Near duplicates by improved consistent weighted sampling.

A text is a weighted set of shingles (five lower-case words; all words of a shorter text), the weight being the number
of times a shingle occurs times an inverse document frequency. Each of ``BANDS`` x ``ROWS`` samples picks one shingle and one
quantised weight, such that two texts pick alike with the probability of their weighted Jaccard similarity. Texts that
agree in all samples of a band are candidates, and candidates are linked if their weighted Jaccard similarity,
computed from the whole texts, is at least ``THRESHOLD``. Classes are the connected components of the links.

No bucket is expanded into all its pairs. Equal texts are one node. In each bucket all nodes are first compared to its
smallest one; after that only pairs of nodes with different classes so far are left to look at. Their samples are
compared in blocks of at most ``BLOCK`` x ``BLOCK``, each its own group, in the first band that a pair shares. Pairs whose
samples make a link plausible are verified in units: the pairs between two sets of nodes, packed, meet the texts of
these nodes, so a dense group of very many near texts moves each text a few times and never a row for each pair.

idf = 1 + min(1, ln(1 / p) / ln(1 / RARE)) for a shingle that stands in the share p of all texts, from 1 (in every text) to 2
(in RARE of them or fewer). It depends on shares only, so a pair of texts is as similar in a large corpus as in a small
one. Only shingles beyond RARE need a number: at most the average text's shingles divided by RARE, whatever the
corpus. They are found by what each part of the corpus holds (a shingle beyond a share of the whole is beyond it in some
part) and then counted exactly.

Nodes are different texts, each named after the smallest id that has it. Rows meet their node by content and one of
``SALTS`` salts, so that a text which a third of all rows hold is no hot key.

Defined cases: null and empty texts are equal to each other and near nothing else; rows are judged by their own text, also where
an id stands with several; a text whose smallest id is null or is that of another text too has a number from 2**62 on, made
from its hash; equal rows are kept together; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.llm.components import components
from tessella.llm.hashing import Words, mix
from tessella.llm.tables import arrow_batches, map_batches, pieces, raw, store, texts_of, whole_text

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 15, 3
#: Share of the texts at and below which a shingle has the largest weight.
RARE = 1 / 128
#: Shingles of one part of the corpus, as they are looked through for frequent ones.
PART = 1 << 22
SALTS = 64
BLOCK = 1024
#: Nodes of one of the sets that a unit of pairs lies between.
UNIT = 2048
#: Share of equal samples from which a pair is verified; a pair at the threshold falls below it with a probability of 5e-5.
PLAUSIBLE = 0.55

LAST = 2**63 - 1
_STEPS = 4096


def _gamma_quantiles(n: int) -> np.ndarray:
    """Quantiles of the gamma distribution of shape 2 and scale 1 at n midpoints, by Newton steps."""
    p = (np.arange(n) + 0.5) / n
    x = np.maximum(-np.log1p(-p), 1e-3) + 0.5
    for _ in range(60):
        x = np.maximum(x - ((1 - np.exp(-x) * (1 + x)) - p) / (x * np.exp(-x)), x / 3)
    return x


_GAMMA = _gamma_quantiles(_STEPS)
_R = _GAMMA.astype(np.float32)
_LOG_C = np.log(_GAMMA).astype(np.float32)


@dataclass
class Frequencies:
    """The frequent shingles, in order, with their idf; all others have 2."""

    hashes: np.ndarray
    weights: np.ndarray

    def idf(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(hashes), 2.0)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            same = self.hashes[at] == hashes
            out[same] = self.weights[at[same]]
        return out


def shingles(texts: pa.Array, chunk: int = 1 << 19) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first text, texts, owner, hash, occurrences) of the distinct shingles, a few texts at a time."""
    data, offsets = raw(pc.utf8_lower(texts))
    for low, high in pieces(offsets, chunk):
        words = Words(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
        hashes, _, owner = words.runs(SHINGLE, whole_short=True)
        order = np.lexsort((hashes, owner))
        hashes, owner = hashes[order], owner[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
        first = np.flatnonzero(new)
        yield low, high - low, owner[first], hashes[first], np.diff(np.concatenate([first, [len(hashes)]]))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(texts, distinct shingles, texts with each) of parts of about ``PART`` shingles."""
    held: list[np.ndarray] = []
    texts = 0
    for batch in batches:
        texts_, seen = texts_of(batch), 0
        for low, n, _, hashes, _ in shingles(texts_):
            held.append(hashes)
            texts, seen = texts + n, low + n
            if sum(map(len, held)) >= PART:
                yield texts, *np.unique(np.concatenate(held), return_counts=True)
                held, texts = [], 0
        texts += len(texts_) - seen
    if texts:
        yield texts, *np.unique(np.concatenate([np.zeros(0, np.uint64), *held]), return_counts=True)


def frequencies(docs: DataFrame, rare: float = RARE) -> Frequencies:
    """Of rows with a ``text``: the shingles in more than the share ``rare`` of them, counted exactly.

    First each part of the corpus names the shingles that more than half that share of it hold. What a part leaves out is
    below half the share of it, so a shingle beyond the share of the whole has more than half its count among what was
    named; the others go. Then those that are left, at most twice the possible number, are counted in all texts."""
    spark, context = docs.sparkSession, docs.sparkSession.sparkContext
    schema = "shingle long, n long"

    def rows(hashes: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(counts.astype(np.int64))], ["shingle", "n"])

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, hashes, counts in _parts(batches):
            most = counts > rare / 2 * texts
            yield rows(hashes[most], counts[most])
            yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([texts], pa.int64())], ["shingle", "n"])

    arrow_batches(spark)
    texts = docs.select("text")
    first = store(texts.mapInArrow(named, schema).groupBy("shingle").agg(F.sum("n").alias("n")), "near-frequent")
    size = first.filter("shingle IS NULL").agg(F.sum("n")).first()[0] or 0
    found = first.filter(F.col("shingle").isNotNull() & (F.col("n") > rare / 2 * size)).select("shingle").toArrow()
    wanted = context.broadcast(np.sort(found["shingle"].to_numpy().view(np.uint64)))
    if not len(wanted.value):
        return Frequencies(np.zeros(0, np.uint64), np.zeros(0))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(wanted.value), np.int64)
        for batch in batches:
            for _, _, _, hashes, _ in shingles(texts_of(batch)):
                at = np.minimum(np.searchsorted(wanted.value, hashes), len(wanted.value) - 1)
                total += np.bincount(at[wanted.value[at] == hashes], minlength=len(total))
        kept = np.flatnonzero(total)
        yield rows(wanted.value[kept], total[kept])

    exact = texts.mapInArrow(counted, schema).groupBy("shingle").agg(F.sum("n").alias("n")).filter(F.col("n") > rare * size).toArrow()
    hashes, share = exact["shingle"].to_numpy().view(np.uint64), exact["n"].to_numpy() / size
    order = np.argsort(hashes)
    return Frequencies(hashes[order], 1 + np.minimum(1, np.log(1 / share[order]) / np.log(1 / rare)))


def samples(owner: np.ndarray, hashes: np.ndarray, weight: np.ndarray, number: int, n: int) -> np.ndarray:
    """The ``number`` samples of each of n texts as 64-bit values; 0 for texts without shingles."""
    out = np.zeros((n, number), np.uint64)
    if not len(owner):
        return out
    starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    own = owner[starts]
    group = np.repeat(np.arange(len(starts)), np.diff(np.concatenate([starts, [len(owner)]])))
    log_weight = np.log(weight).astype(np.float32)
    one, low_bits = np.uint64(0xFFF), np.uint64(0xFFFFF)
    for k in range(number):
        # four bits of randomness from one hash: r, c and beta of this shingle in this sample
        z = (hashes ^ np.uint64((k + 1) * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xC4CEB9FE1A85EC53)
        z ^= z >> np.uint64(31)
        r = _R[(z & one).astype(np.intp)]
        c = _LOG_C[((z >> np.uint64(12)) & one).astype(np.intp)]
        beta = ((z >> np.uint64(24)) & low_bits).astype(np.float32) * np.float32(1 / (1 << 20))
        t = np.floor(log_weight / r + beta)
        a = c - r * (t - beta + np.float32(1))
        least = np.minimum.reduceat(a, starts)
        at = np.flatnonzero(a == least[group])
        first = at[np.searchsorted(group[at], np.arange(len(starts)))]
        out[own, k] = mix(hashes[first] + t[first].astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k))
    return out


def signatures(docs: DataFrame, shared) -> DataFrame:
    """(doc_id, content, bands, samples) of rows (doc_id, content, text)."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        table, number = shared.value, BANDS * ROWS
        found = np.zeros((batch.num_rows, number), np.uint64)
        empty = np.ones(batch.num_rows, bool)
        for low, n, owner, hashes, times in shingles(texts_of(batch)):
            found[low : low + n] = samples(owner, hashes, times * table.idf(hashes), number, n)
            empty[low + owner] = False
        bands = np.zeros((batch.num_rows, BANDS), np.uint64)
        for b in range(BANDS):
            key = np.full(batch.num_rows, b + 1, np.uint64)
            for k in range(b * ROWS, (b + 1) * ROWS):
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + found[:, k])
            bands[:, b] = key
        lists = [None if e else x for e, x in zip(empty.tolist(), bands.view(np.int64).tolist(), strict=True)]
        short = (found >> np.uint64(32)).astype("<u4")
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(lists, pa.list_(pa.int64())), pa.array([x.tobytes() for x in short], pa.binary())],
            ["doc_id", "content", "bands", "samples"],
        )

    return map_batches(docs, work, "doc_id long, content binary, bands array<long>, samples binary")


def content_of(text: Column) -> Column:
    """What equal texts share: the digest of a text, null being empty."""
    return F.unhex(F.sha2(whole_text(text).cast("binary"), 256))


def weighted(text: str, table: Frequencies) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of a text, in order, and their weights."""
    found = list(shingles(pa.array([text])))
    if not found or not len(found[0][3]):
        return np.zeros(0, np.uint64), np.zeros(0)
    _, _, _, hashes, times = found[0]
    return hashes, times * table.idf(hashes)


def jaccard(one: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two sets of shingles."""
    (ha, wa), (hb, wb) = one, other
    if not len(ha) or not len(hb):
        return 0.0
    at = np.minimum(np.searchsorted(ha, hb), len(ha) - 1)
    same = ha[at] == hb
    both = np.minimum(wa[at[same]], wb[same]).sum()
    return float(both / (wa.sum() + wb.sum() - both))


def similarities(pairs: DataFrame, texts: DataFrame, shared) -> DataFrame:
    """(a, b, similarity) of pairs (a, b) of nodes with their rows (node, text)."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        known: dict[str, tuple] = {}
        left, right, out = batch.column(2).to_pylist(), batch.column(3).to_pylist(), []
        for one, other in zip(left, right, strict=True):
            if one not in known:
                if len(known) > 64:
                    known.clear()
                known[one] = weighted(one, shared.value)
            out.append(jaccard(known[one], weighted(other, shared.value)))
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.float64())], ["a", "b", "similarity"])

    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return map_batches(joined, work, "a long, b long, similarity double", rows=500)


def packed_links(packed: DataFrame, texts: DataFrame, shared, threshold: float) -> DataFrame:
    """The links (a, b) among the pairs of rows (i, j, pairs), each row holding pairs of one unit (i, j)."""

    def nodes(table: pa.Table) -> pa.Table:
        found = np.unique(np.frombuffer(b"".join(table["pairs"].to_pylist()), "<i8"))
        unit = {n: pa.array(np.full(len(found), table[n][0].as_py()), pa.int64()) for n in ("i", "j")}
        return pa.table({**unit, "node": pa.array(found, pa.int64())})

    def verify(pairs: pa.Table, own: pa.Table) -> pa.Table:
        known = {n: weighted(t, shared.value) for n, t in zip(own["node"].to_pylist(), own["text"].to_pylist(), strict=True)}
        each = np.frombuffer(b"".join(pairs["pairs"].to_pylist()), "<i8").reshape(-1, 2)
        good = [(a, b) for a, b in each.tolist() if jaccard(known[a], known[b]) >= threshold]
        return pa.table({"a": pa.array([a for a, _ in good], pa.int64()), "b": pa.array([b for _, b in good], pa.int64())})

    asked = packed.groupBy("i", "j").applyInArrow(nodes, "i long, j long, node long")
    own = asked.join(texts, "node").select("i", "j", "node", "text")
    return packed.groupBy("i", "j").cogroup(own.groupBy("i", "j")).applyInArrow(verify, "a long, b long")


def cross_pairs(members: DataFrame, sets: int, plausible: float = PLAUSIBLE, block: int = BLOCK) -> DataFrame:
    """Rows (i, j, pairs): the pairs of nodes in one bucket whose labels differ and whose samples make a link
    plausible, packed by the two of ``sets`` sets of nodes that they lie between; for rows
    (key, band, node, label, samples).

    The nodes of a bucket's largest label are not compared to each other, so the others, the few, go to every block
    of the bucket, and those of the largest label to the blocks of the few.
    """
    by_label = members.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
    sizes = by_label.groupBy("key").agg(F.sum("n").alias("n"), F.max(F.struct("n", "label")).alias("top"), F.count(F.lit(1)).alias("labels"))
    sizes = sizes.filter("labels > 1").select("key", F.col("top.label").alias("top"), F.ceil((F.col("n") - F.col("top.n")) / block).alias("few"), F.ceil(F.col("n") / block).alias("all"))
    own = members.join(sizes, "key").withColumn("is_few", F.col("label") != F.col("top"))
    dice = lambda n: F.pmod(F.xxhash64("node"), F.col(n))
    # group (i, j) holds the i-th block of the few and the j-th block of all
    every = F.transform(F.sequence(F.lit(0).cast("long"), F.col("few") - 1), lambda i: F.struct(i.alias("i"), dice("all").alias("j"), F.lit(False).alias("left")))
    mine = F.transform(F.sequence(F.lit(0).cast("long"), F.col("all") - 1), lambda j: F.struct(dice("few").alias("i"), j.alias("j"), F.lit(True).alias("left")))
    none = F.array().cast("array<struct<i:long,j:long,left:boolean>>")
    dealt = own.select("key", "band", "node", "label", "samples", F.explode(F.concat(every, F.when(F.col("is_few"), mine).otherwise(none))).alias("g"))
    dealt = dealt.select("key", "band", "g.i", "g.j", "g.left", "node", "label", "samples")

    def compare(table: pa.Table) -> pa.Table:
        left = table["left"].to_numpy(zero_copy_only=False)
        node, label = table["node"].to_numpy(), table["label"].to_numpy()
        band = table["band"][0].as_py()
        each = np.frombuffer(b"".join(table["samples"].to_pylist()), "<u4").reshape(-1, BANDS * ROWS)
        ones, others = np.flatnonzero(left), np.flatnonzero(~left)
        out = []
        for x in ones:
            cross = others[label[others] != label[x]]
            same = each[cross] == each[x]
            near = same.sum(1) >= plausible * BANDS * ROWS
            first = same[near].reshape(-1, BANDS, ROWS).all(2).argmax(1) == band
            found = node[cross[near][first]]
            out.append(np.stack([np.minimum(found, node[x]), np.maximum(found, node[x])], 1))
        pairs = np.unique(np.concatenate(out), axis=0) if out else np.zeros((0, 2), np.int64)
        unit = np.sort((mix(pairs.astype(np.uint64)) % np.uint64(sets)).astype(np.int64), axis=1)
        order = np.lexsort((unit[:, 1], unit[:, 0]))
        pairs, unit = pairs[order], unit[order]
        starts = np.flatnonzero(np.concatenate([[True], (unit[1:] != unit[:-1]).any(1)])) if len(unit) else np.zeros(0, np.int64)
        ends = np.append(starts[1:], len(unit))
        rows = [pairs[p:q].astype("<i8").tobytes() for p, q in zip(starts, ends, strict=False)]
        return pa.table({"i": pa.array(unit[starts, 0], pa.int64()), "j": pa.array(unit[starts, 1], pa.int64()), "pairs": pa.array(rows, pa.binary())})

    return dealt.groupBy("key", "i", "j").applyInArrow(compare, "i long, j long, pairs binary")


def _nodes(signed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes (content, least, node), contents (content, salt)) of rows (doc_id, content, salt); ``least`` is the smallest
    id that has the content, 2**63 - 1 for null ones."""
    ids = F.coalesce("doc_id", F.lit(LAST))
    contents = store(signed.groupBy("content", "salt").agg(F.min(ids).alias("least")), "near-contents")
    least = contents.groupBy("content").agg(F.min("least").alias("least"))
    made = F.xxhash64("content").bitwiseAND(F.lit((1 << 62) - 1)) + F.lit(1 << 62)
    named = least.filter(F.col("least") < LAST)
    several = named.groupBy("least").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    own = named.join(several, "least", "left").select("content", "least", F.when(F.col("n").isNull(), F.col("least")).otherwise(made).alias("node"))
    unnamed = least.filter(F.col("least") == LAST).select("content", "least", made.alias("node"))
    return store(own.union(unnamed), "near-nodes"), contents.select("content", "salt")


def classes(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, content, node, class_id and kept of each row; class_id is the smallest node of the class, and of each
    class the row with its smallest id is kept."""
    spark = docs.sparkSession
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), whole_text(docs[text_col]).alias("text"))
    content = content_of(F.col("text"))
    named = rows.select("doc_id", content.alias("content"), "text")
    shared = spark.sparkContext.broadcast(frequencies(rows))
    signed = store(signatures(named, shared), "near-signatures")
    salted = signed.select("doc_id", "content", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).alias("salt"))
    nodes, contents = _nodes(salted)

    first = nodes.select("content", F.nullif("least", F.lit(LAST)).alias("first"), "node")
    of_node = lambda df: df.join(first, (df["content"] == first["content"]) & df["doc_id"].eqNullSafe(first["first"])).drop(first["content"])
    keyed = of_node(signed.filter("bands IS NOT NULL")).select("node", "samples", F.posexplode("bands").alias("band", "key"))
    buckets = keyed.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("most")).filter("least < most")
    members = store(keyed.join(buckets.select("key", "least"), "key"), "near-members")

    needed = members.select("node").distinct().join(nodes, "node").select("node", F.nullif("least", F.lit(LAST)).alias("first"), F.col("content").alias("own"))
    texts = named.join(needed, (named["content"] == needed["own"]) & named["doc_id"].eqNullSafe(needed["first"])).select("node", "text").dropDuplicates(["node"])
    texts = store(texts, "near-texts")
    star = members.select(F.col("least").alias("a"), F.col("node").alias("b")).filter("a < b").distinct()
    good = store(similarities(star, texts, shared).filter(F.col("similarity") >= threshold).select("a", "b"), "near-links")
    label = components(good, "near-classes")

    labelled = members.join(label, "node", "left").select("key", "band", "node", F.coalesce("label", "node").alias("label"), "samples")
    rest = store(cross_pairs(labelled, max(1, math.ceil(texts.count() / UNIT))), "near-rest")
    more = store(packed_links(rest, texts, shared, threshold), "near-links")
    final = components(good.union(more), "near-classes")
    classed = nodes.join(final, "node", "left").select("content", "least", "node", F.coalesce("label", "node").alias("class_id"))
    by_salt = contents.join(classed, "content")
    kept = (F.col("node") == F.col("class_id")) & (F.coalesce("doc_id", F.lit(LAST)) == F.col("least"))
    return salted.join(by_salt, ["content", "salt"]).select("doc_id", "content", "node", "class_id", kept.alias("kept"))
