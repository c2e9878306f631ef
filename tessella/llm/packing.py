"""Best-fit packing of token sequences: bounded space, online.

Each document becomes its token ids and one end id. A longer one than a sequence is cut into whole sequences, with
the rest in front. What is shorter than a sequence goes into the open sequence with the least free space that still
holds it. A fixed number of sequences is open; a bitset, keyed by free space, says which amounts of space are on offer,
so the best fit is its lowest bit at or above the length. When all are open and none fits, the fullest is closed.

Packers work side by side, each on a share of the pieces that is dealt out by a hash of the key and is large
enough that the open sequences it ends with do not count. The order in which a packer gets its pieces is free: they
come in random blocks of about as many documents as there may be open sequences, the longest of a block first.

Defined cases: a null or empty text is its end id alone; an empty table gives no rows; repeated rows and null ids
are packed like any others, each row by itself.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.tables import map_batches, texts_of, whole_text
from tessella.llm.tokenization import encoder

LENGTH = 1024
END_ID = 2
OPEN_BINS = 1024
#: Documents of one packer.
SHARE = 25_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACES = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


class OpenBins:
    """At most ``limit`` open bins of ``capacity``; ``place`` gives (bin, offset) of an item."""

    def __init__(self, capacity: int = LENGTH, limit: int = OPEN_BINS):
        self.capacity, self.limit = capacity, limit
        self.offered = 0  # bit f: some open bin has f free
        self.by_space: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.open = self.made = 0

    def _take(self, space: int) -> int:
        bins = self.by_space[space]
        found = bins.pop()
        if not bins:
            self.offered ^= 1 << space
        self.open -= 1
        return found

    def place(self, length: int) -> tuple[int, int]:
        fits = self.offered >> length
        if fits:
            space = length + (fits & -fits).bit_length() - 1
            found = self._take(space)
        else:
            if self.open >= self.limit:  # close the fullest: the least free space
                self._take((self.offered & -self.offered).bit_length() - 1)
            space, found = self.capacity, self.made
            self.made += 1
        if left := space - length:
            self.by_space[left].append(found)
            self.offered |= 1 << left
            self.open += 1
        return found, self.capacity - space


def cut(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """The pieces of rows (doc_id, text): place, length and crc32 of the ids."""
    tail = np.array([end_id], "<u4").tobytes()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        encode, rows = encoder(tokenizer).encode, ([], [], [], [], [])
        for doc, text in zip(batch.column(0).to_pylist(), texts_of(batch).to_pylist(), strict=True):
            ids = encode(text) + tail
            n = len(ids) // 4
            edges = [0, *range(n % length or length, n + 1, length)]
            for k, (low, high) in enumerate(zip(edges, edges[1:], strict=False)):
                for column, value in zip(rows, (doc, k, low, high - low, zlib.crc32(ids[4 * low : 4 * high])), strict=True):
                    column.append(value)
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return map_batches(docs.select("doc_id", "text"), work, PIECES)


def fit(capacity: int, limit: int):
    """Places the pieces of one packer in the order in which they come."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins: dict[int, OpenBins] = {}
        for batch in batches:
            sequence, offset = [], []
            shares = batch.column(batch.schema.get_field_index("share")).to_pylist()
            lengths = batch.column(batch.schema.get_field_index("length")).to_pylist()
            for share, length in zip(shares, lengths, strict=True):
                mine = bins.get(share)
                if mine is None:
                    mine = bins[share] = OpenBins(capacity, limit)
                found, at = mine.place(length)
                sequence.append((share << 40) + found)
                offset.append(at)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(n)) for n in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return run


def pack(
    docs: DataFrame,
    tokenizer: str,
    length: int = LENGTH,
    end_id: int = END_ID,
    open_bins: int = OPEN_BINS,
    share: int = SHARE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece of each document, with its sequence and its place there."""
    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), whole_text(docs[text_col]).alias("text"))
    number = docs.select(F.lit(1)).count()
    packers = max(1, math.ceil(number / share))
    keyed = cut(texts, tokenizer, length, end_id)
    dealt = keyed.withColumn("share", F.pmod(F.xxhash64("doc_id", "ids_crc32", "piece"), F.lit(packers)))
    # a fixed order, so that a packer that runs again makes the same sequences
    block = F.pmod(F.xxhash64("ids_crc32", "doc_id"), F.lit(max(1, math.ceil(number / packers / open_bins))))
    order = ["share", block, F.desc("length"), "doc_id", "piece", "start", "ids_crc32"]
    return dealt.repartition(packers, "share").sortWithinPartitions(*order).mapInArrow(fit(length, open_bins), PLACES)
