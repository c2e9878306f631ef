"""Removal of repeated passages by fixed-block anchors.

A passage is a run of ``WINDOW`` consecutive words. Every document's text is cut into blocks of half that many words,
which do not overlap; these are the anchors. Any passage that two documents share holds a whole block of each, so
probing the index of blocks with every rolling run of block length finds it in both. Hits are then extended: each window
around a hit is looked up by two independent 64-bit hashes (``hashing.run_hashes``), which gives the document with the
smallest id that has it; windows in a row are the maximal repeats, and their words go, save in that document. Of 10**13
windows two different ones have both hashes alike with a probability of 2e-13.

How it runs: documents are dealt into batches by a hash of their key and text. A batch sends its distinct hashes to buckets, as one
packed row for each bucket, and a bucket answers the batches that sent them. So a passage that a third of all documents
hold counts once a batch, no pairs of documents are ever made, and hashes cost a few bytes a word in the shuffle. Between
anchors and probes 32 bits within a bucket are compared; what they let through by chance the windows' hashes sort out.

Defined cases: null and empty texts have no words; a text shorter than a window keeps all its words; documents with the
same id do not remove from each other (rows with an id repeated are judged each by itself); a null id is larger than all
others; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.hashing import Words, mix
from tessella.llm.tables import arrow_batches, raw, whole_text

WINDOW = 50
LAST = np.iinfo(np.int64).max
KEPT = "doc_id long, n_words long, n_removed long, kept string"


def share_bytes(total: int) -> int:
    """Bytes of text of a batch and of a bucket: more as the input grows, so that the rows between them stay
    long, and at most what a worker holds with ease."""
    return int(min(64 << 20, max(4 << 20, 150 * math.sqrt(total))))


class Batch:
    """The rows of one batch that have a window, as arrays."""

    def __init__(self, table: pa.Table, window: int):
        self.table = table.combine_chunks()
        column = self.table["text"]
        texts = column.chunk(0) if column.num_chunks else pa.array([], pa.string())
        self.data, self.offsets = raw(texts.fill_null(""))
        self.words = Words(self.data, self.offsets)
        order = self.table["doc_id"].fill_null(LAST).to_numpy()
        self.order = order.astype(np.int64)
        # a document without a window can neither give nor lose one
        self.words.long = self.words.count >= window

    def runs(self, size: int):
        """(hash, first word, row) of all runs of ``size`` words of rows that have a window."""
        hashes, first, row = self.words.runs(size)
        kept = self.words.long[row]
        return hashes[kept], first[kept], row[kept]

    def checks(self, size: int) -> np.ndarray:
        """A second hash, independent of the first, of the same runs."""
        hashes, _, row = self.words.runs(size, hashes=self.words.hashes(seed=1))
        return hashes[self.words.long[row]]


def _deal(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each hash, by bits independent of it within the bucket."""
    return (mix(hashes ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(buckets)).astype(np.int64)


def _short(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(32)).astype(np.uint32)


def _starts(ordered: np.ndarray) -> np.ndarray:
    """Where each group of equal neighbours begins."""
    if not len(ordered):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))


def _grouped(hashes: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, where each group begins) of runs that are equal in both hashes."""
    order = np.argsort(hashes, kind="stable")
    h, c = hashes[order], checks[order]
    if ((h[1:] == h[:-1]) & (c[1:] != c[:-1])).any():
        order = np.lexsort((checks, hashes))
        h, c = hashes[order], checks[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (c[1:] != c[:-1])
    return order, np.flatnonzero(new)


def _among(hashes: np.ndarray, checks: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Which runs are among the wanted ones, rows of (hash, check) in order of the hash."""
    out = np.zeros(len(hashes), bool)
    if len(wanted):
        at = np.searchsorted(wanted[:, 0], hashes)
        same = np.arange(len(hashes))
        while len(same):
            same = same[at[same] < len(wanted)]
            same = same[wanted[at[same], 0] == hashes[same]]
            out[same] |= wanted[at[same], 1] == checks[same]
            same = same[~out[same]]
            at[same] += 1
    return out


def _packed(batch: int, bucket: np.ndarray, **columns: np.ndarray) -> pa.Table:
    """One row for each bucket (in order) with the columns' bytes."""
    edges = np.concatenate([_starts(bucket), [len(bucket)]])
    out = {"bucket": pa.array(bucket[edges[:-1]], pa.int64()), "batch": pa.array(np.full(len(edges) - 1, batch), pa.int64())}
    for name, values in columns.items():
        out[name] = pa.array([values[a:b].tobytes() for a, b in zip(edges, edges[1:], strict=False)], pa.binary())
    return pa.table(out)


def _joined(table: pa.Table, name: str, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """(all values of a packed column, the row of each)."""
    parts = [np.frombuffer(x, kind) for x in table[name].to_pylist()]
    rows = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    return (np.concatenate(parts) if parts else np.zeros(0, kind)), rows


def _places(hits: pa.Table, buckets: int, batch: Batch, block: int):
    """Candidate windows: (hash, check, row) of those that hold a hit."""
    probes, first, row = batch.runs(block)
    wanted, of = _joined(hits, "found", "<u4")
    wanted = np.unique((hits["bucket"].to_numpy()[of].astype(np.uint64) << np.uint64(32)) | wanted)
    mine = (_deal(probes, buckets).astype(np.uint64) << np.uint64(32)) | _short(probes)
    at = np.searchsorted(wanted, mine)
    hit = (at < len(wanted)) & (wanted[np.minimum(at, max(len(wanted) - 1, 0))] == mine) if len(wanted) else np.zeros(len(mine), bool)
    marks = np.zeros(len(batch.words.start) + 1, np.int64)
    marks[first[hit] + 1] = 1
    np.cumsum(marks, out=marks)
    hashes, begin, own = batch.runs(2 * block)
    near = marks[begin + block + 1] > marks[begin]
    return hashes[near], batch.checks(2 * block)[near], own[near]


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed and the kept words (joined by one blank) of each document."""
    if window % 2:
        raise ValueError("the window must be an even number of words")
    block = window // 2
    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), whole_text(docs[text_col]).alias("text"))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, math.ceil(total / share_bytes(total)))
    arrow_batches(docs.sparkSession, 10_000)
    dealt = texts.withColumn("batch", F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)))
    by_batch = dealt.groupBy("batch")

    def anchors(table: pa.Table) -> pa.Table:
        batch = Batch(table, window)
        hashes, first, row = batch.runs(block)
        is_block = (first - batch.words.bounds[:-1][row]) % block == 0
        key = (_deal(hashes, parts).astype(np.uint64) << np.uint64(32)) | _short(hashes)
        order = np.argsort(key, kind="stable")
        key, is_block, own = key[order], is_block[order], batch.order[row[order]]
        starts = _starts(key)
        if not len(starts):
            return _packed(0, np.zeros(0, np.int64), hashes=np.zeros(0, "<u4"), flags=np.zeros(0, np.uint8))
        several = np.minimum.reduceat(own, starts) != np.maximum.reduceat(own, starts)
        flags = np.logical_or.reduceat(is_block, starts).astype(np.uint8) | (several.astype(np.uint8) << 1)
        key = key[starts]
        return _packed(table["batch"][0].as_py(), (key >> np.uint64(32)).astype(np.int64), hashes=key.astype("<u4"), flags=flags)

    def meet(table: pa.Table) -> pa.Table:
        """The hashes of a bucket that are a block of one document and a run of another, for each batch."""
        hashes, row = _joined(table, "hashes", "<u4")
        flags, _ = _joined(table, "flags", "u1")
        order = np.argsort(hashes, kind="stable")
        starts = _starts(hashes[order])
        number = np.diff(np.concatenate([starts, [len(order)]]))
        both = np.bitwise_or.reduceat(flags[order], starts) if len(starts) else np.zeros(0, np.uint8)
        good = ((both & 1) > 0) & ((number > 1) | ((both & 2) > 0))
        hit = np.zeros(len(order), bool)
        hit[order] = np.repeat(good, number)
        return _answers(table, hashes, row, hit)

    def _answers(table: pa.Table, hashes: np.ndarray, row: np.ndarray, hit: np.ndarray) -> pa.Table:
        edges = np.searchsorted(row[hit], np.arange(table.num_rows + 1))
        found = hashes[hit]
        lists = [found[a:b].tobytes() for a, b in zip(edges, edges[1:], strict=False)]
        out = pa.table({"batch": table["batch"], "bucket": table["bucket"], "found": pa.array(lists, pa.binary())})
        return out.filter(pa.array(np.diff(edges) > 0))

    def candidates(table: pa.Table, hits: pa.Table) -> pa.Table:
        empty = _packed(0, np.zeros(0, np.int64), hashes=np.zeros(0, "<u8"), least=np.zeros(0, "<i8"))
        if not table.num_rows or not hits.num_rows:
            return empty
        batch = Batch(table, window)
        hashes, checks, row = _places(hits, parts, batch, block)
        order, starts = _grouped(hashes, checks)
        if not len(starts):
            return empty
        least = np.minimum.reduceat(batch.order[row[order]], starts)
        hashes, checks = hashes[order[starts]], checks[order[starts]]
        bucket = _deal(hashes, parts)
        order = np.lexsort((hashes, least, bucket))  # equal ids side by side pack well
        both = np.stack([hashes[order], checks[order]], 1).astype("<u8")
        return _packed(table["batch"][0].as_py(), bucket[order], hashes=both, least=least[order].astype("<i8"))

    def smallest(table: pa.Table) -> pa.Table:
        """The windows of a bucket that begin in a smaller document of another batch, for each batch."""
        least, row = _joined(table, "least", "<i8")
        both = _joined(table, "hashes", "<u8")[0].reshape(-1, 2)
        order, starts = _grouped(both[:, 0], both[:, 1])
        number = np.diff(np.concatenate([starts, [len(order)]]))
        first = np.minimum.reduceat(least[order], starts) if len(starts) else least
        hit = np.zeros(len(order), bool)
        hit[order] = np.repeat(first, number) < least[order]
        return _answers(table, both, row, hit)

    def finish(table: pa.Table, foreign: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.table({"doc_id": pa.array([], pa.int64()), "n_words": pa.array([], pa.int64()), "n_removed": pa.array([], pa.int64()), "kept": pa.array([], pa.string())})
        batch = Batch(table, window)
        hashes, first, row = batch.runs(window)
        own, checks = batch.order[row], batch.checks(window)
        order, starts = _grouped(hashes, checks)
        gone = np.zeros(len(hashes), bool)
        if len(starts):
            number = np.diff(np.concatenate([starts, [len(order)]]))
            gone[order] = np.repeat(np.minimum.reduceat(own[order], starts), number) < own[order]
            wanted = _joined(foreign, "found", "<u8")[0].reshape(-1, 2)
            gone |= _among(hashes, checks, wanted[np.argsort(wanted[:, 0], kind="stable")])
        words = batch.words
        marks = np.zeros(len(words.start) + 1, np.int64)
        np.add.at(marks, first[gone], 1)
        np.add.at(marks, first[gone] + window, -1)
        removed = np.cumsum(marks)[:-1] > 0
        sums = np.concatenate([[0], np.cumsum(removed)])
        lost = sums[words.bounds[1:]] - sums[words.bounds[:-1]]
        kept = []
        for i in range(table.num_rows):
            each = self_bytes(batch, i).split()
            if lost[i]:
                stay = ~removed[words.bounds[i] : words.bounds[i + 1]]
                each = [each[j] for j in np.flatnonzero(stay)]
            kept.append(b" ".join(each))
        ids = batch.table["doc_id"]
        return pa.table({"doc_id": ids, "n_words": pa.array(words.count, pa.int64()), "n_removed": pa.array(lost, pa.int64()), "kept": pa.array(kept, pa.binary()).cast(pa.string())})

    def self_bytes(batch: Batch, i: int) -> bytes:
        return batch.data[batch.offsets[i] : batch.offsets[i + 1]].tobytes()

    sent = by_batch.applyInArrow(anchors, "bucket long, batch long, hashes binary, flags binary")
    answers = "batch long, bucket long, found binary"
    hits = sent.groupBy("bucket").applyInArrow(meet, answers)
    asked = by_batch.cogroup(hits.groupBy("batch")).applyInArrow(candidates, "bucket long, batch long, hashes binary, least binary")
    foreign = asked.groupBy("bucket").applyInArrow(smallest, answers)
    return by_batch.cogroup(foreign.groupBy("batch")).applyInArrow(finish, KEPT)
