"""Document fingerprints: bottom-k sketches of shingle hashes.

A fingerprint holds the ``K`` smallest of the distinct 64-bit hashes of a text's shingles (five words; all words of a
shorter text). The sketch of a union is the bottom k of the sketches put together, so sketches of parts are
merged without their texts. Two sketches estimate resemblance and containment, and one the number of distinct shingles.
As text, a sketch is the base64 of its hashes in order, eight bytes each, the largest byte first.

Neighbours in the order of ids meet without a sort of all rows in one task: the ids are cut into ranges at quantiles, a
text goes once to the task of its range, which reads its range in order, and the first text of a range is also
sent to the range before it.

Defined cases: null and empty texts have an empty sketch; two empty sketches are alike (1), an empty and another are
not (0); null ids come first in the order and ties are in the order of their texts; a single document is its own next
one; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.llm.hashing import Words
from tessella.llm.tables import arrow_batches, fresh, pieces, raw, texts_of, whole_text

K = 128
SHINGLE = 5
#: Rows of a range of ids, and the most ranges.
RANGE_ROWS, MOST_RANGES = 5_000, 20_000

NEIGHBOURS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def sketches(texts: pa.Array, k: int = K, shingle: int = SHINGLE) -> list[np.ndarray]:
    """The bottom k hashes of each text, in order."""
    data, offsets = raw(texts)
    out: list[np.ndarray] = []
    for low, high in pieces(offsets, 1 << 19):
        words = Words(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
        hashes, _, owner = words.runs(shingle, whole_short=True)
        edges = np.searchsorted(owner, np.arange(high - low + 1))
        for a, b in zip(edges, edges[1:], strict=False):
            own = hashes[a:b]
            if len(own) > 4 * k:  # repeats make the bottom smaller, so look further until there are k of them
                take = 2 * k
                while take < len(own):
                    least = np.unique(np.partition(own, take)[:take])
                    if len(least) >= k:
                        break
                    take *= 4
                else:
                    least = np.unique(own)
            else:
                least = np.unique(own)
            out.append(least[:k])
    return out


def merge(parts: list[np.ndarray], k: int = K) -> np.ndarray:
    """The sketch of the union."""
    return np.unique(np.concatenate(parts))[:k] if parts else np.zeros(0, np.uint64)


def resemblance(one: np.ndarray, other: np.ndarray, k: int = K) -> float:
    """Estimated Jaccard similarity: the share of the union's bottom k that both hold."""
    if not len(one) or not len(other):
        return float(len(one) == len(other))
    union = np.union1d(one, other)[:k]
    return len(np.intersect1d(np.intersect1d(one, other, assume_unique=True), union, assume_unique=True)) / len(union)


def distinct_shingles(sketch: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles; exact below k."""
    if len(sketch) < k:
        return float(len(sketch))
    return (k - 1) / ((float(sketch[k - 1]) + 1) / 2.0**64)


def containment(one: np.ndarray, other: np.ndarray, k: int = K) -> float:
    """Estimated share of the first one's shingles that the other has."""
    if not len(one):
        return 1.0
    union = distinct_shingles(merge([one, other], k), k)
    return min(1.0, resemblance(one, other, k) * union / max(distinct_shingles(one, k), 1.0))


def as_text(sketch: np.ndarray) -> str:
    return base64.b64encode(sketch.astype(">u8").tobytes()).decode()


def from_text(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), ">u8").astype(np.uint64)


def fingerprint(docs: DataFrame, k: int = K) -> DataFrame:
    """All columns of rows with a ``text``, and ``fingerprint``."""
    name = fresh("fingerprint", docs.columns)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column(name, pa.array([as_text(s) for s in sketches(texts_of(batch), k)], pa.string()))

    arrow_batches(docs.sparkSession)
    return docs.mapInArrow(work, docs.withColumn(name, F.lit("")).schema)


def merged(prints: DataFrame, group: str, column: str = "fingerprint", k: int = K, salts: int = 64) -> DataFrame:
    """One fingerprint for each group of fingerprints, in two steps, so that a group of very many rows is shared
    out first."""

    def union(table: pa.Table) -> pa.Table:
        found, part = np.zeros(0, np.uint64), []
        for text in table[column].to_pylist():
            part.append(from_text(text))
            if len(part) == 256:
                found, part = merge([found, *part], k), []
        return pa.table({group: table[group][:1], column: pa.array([as_text(merge([found, *part], k))])})

    schema = prints.select(group, column).schema
    salted = prints.select(group, column, F.pmod(F.xxhash64(column), F.lit(salts)).alias("_salt"))
    return salted.groupBy(group, "_salt").applyInArrow(union, schema).groupBy(group).applyInArrow(union, schema)


def _range_of(bounds: list[int]) -> Column:
    edges = np.array(bounds, np.int64)

    @F.pandas_udf("int")
    def place(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, ids.to_numpy(np.int64), "right").astype(np.int32))

    return place(F.coalesce("doc_id", F.lit(np.iinfo(np.int64).min).cast("long")))


def with_next(docs: DataFrame, range_rows: int = RANGE_ROWS) -> tuple[DataFrame, int]:
    """Rows (part, tail, doc_id, text), each range of ids in one task and in order, and the number of ranges. The
    last row of a range is a ``tail``: the first row of the next range (after the last: of the first)."""
    ids = docs.select(F.coalesce("doc_id", F.lit(np.iinfo(np.int64).min).cast("long")).alias("doc_id"))
    n = ids.count()
    ranges = max(1, min(MOST_RANGES, math.ceil(n / range_rows)))
    bounds: list[int] = []
    if ranges > 1:
        shares = [i / ranges for i in range(1, ranges)]
        found = ids.agg(F.percentile_approx("doc_id", shares, max(10_000, 10 * ranges)).alias("b")).first()["b"]
        bounds = sorted(set(found))
    placed = docs.withColumn("part", _range_of(bounds))
    # the first row of each range, at most as many as there are ranges
    first = placed.groupBy("part").agg(F.min(F.struct(F.coalesce("doc_id", F.lit(np.iinfo(np.int64).min).cast("long")).alias("id"), F.xxhash64("text").alias("h"))).alias("first"))
    heads = sorted((r["part"], r["first"]["id"], r["first"]["h"]) for r in first.collect())
    if not heads:
        return placed.select("part", F.lit(False).alias("tail"), "doc_id", "text"), 1
    before = [heads[i - 1][0] for i in range(len(heads))]
    small = docs.sparkSession.createDataFrame([(p, q) for (p, _, _), q in zip(heads, before, strict=True)], "part int, before int")
    marks = F.struct(F.coalesce("doc_id", F.lit(np.iinfo(np.int64).min).cast("long")).alias("id"), F.xxhash64("text").alias("h"))
    head_ids = docs.sparkSession.createDataFrame([(p, i, h) for p, i, h in heads], "part int, id long, h long")
    head_rows = placed.join(F.broadcast(head_ids), (placed["part"] == head_ids["part"]) & (marks["id"] == head_ids["id"]) & (marks["h"] == head_ids["h"])).select(placed["part"], "doc_id", "text")
    tails = head_rows.dropDuplicates(["part"]).join(F.broadcast(small), "part").select(F.col("before").alias("part"), F.lit(True).alias("tail"), "doc_id", "text")
    rows = placed.select("part", F.lit(False).alias("tail"), "doc_id", "text").unionByName(tails)
    order = ["part", "tail", F.asc_nulls_first("doc_id"), F.xxhash64("text")]
    return rows.repartition(len(heads), "part").sortWithinPartitions(*order), len(heads)


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many of the following text."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def with_neighbours(docs: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text", range_rows: int = RANGE_ROWS) -> DataFrame:
    """Each document with its fingerprint, that of its edited text, and how like they and the next document are."""
    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), whole_text(docs[text_col]).alias("text"))
    rows, _ = with_next(texts, range_rows)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # (part, doc_id, text, sketch) of the row before
        for batch in batches:
            part, tail, ids = (batch.column(i).to_pylist() for i in range(3))
            found = sketches(texts_of(batch), k)
            pairs = []
            for row in zip(part, tail, ids, texts_of(batch).to_pylist(), found, strict=True):
                if last is not None and last[0] == row[0]:
                    pairs.append((*last[2:], row[3], row[4]))
                last = None if row[1] else row
            if not pairs:
                continue
            changed = [edited(text, following) for _, text, _, following, _ in pairs]
            after = sketches(pa.array(changed, pa.string()), k)
            columns = [
                pa.array([p[0] for p in pairs], pa.int64()),
                pa.array([len(p[1]) for p in pairs], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]),
                pa.array([as_text(p[2]) for p in pairs]),
                pa.array([as_text(s) for s in after]),
                pa.array([resemblance(p[2], s, k) for p, s in zip(pairs, after, strict=True)], pa.float64()),
                pa.array([resemblance(p[2], p[4], k) for p in pairs], pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    arrow_batches(docs.sparkSession)
    return rows.mapInArrow(work, NEIGHBOURS)
