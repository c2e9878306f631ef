"""Benchmark decontamination by spaced seeds, in DataFrame operations only.

Texts are sequences of lower-case words (runs of letters and digits). A mask is a short pattern of positions that count
and positions that are ignored; the counting words of each window, hashed, are the window's seed. Masks that ignore
different positions find passages in which words have been replaced. Seeds of all documents are joined to those of the
benchmark, and a hit is verified by the best-matching run around it: from the window to either side, words are compared
position by position up to where equal ones most outnumber others. The run must hold ``LEAST_EQUAL`` equal words, and
they must be ``LEAST_SHARE`` of it.

The masks were chosen by simulation: together they find every passage of 20 words in which every third, fourth, fifth or
later word is replaced, and with words replaced at random one in five, 85 % of passages of 15 words, 97 % of 20 and all of 30.

The benchmark's seeds and words are broadcast if there are at most ``BROADCAST_SEEDS`` seeds, which is counted first;
beyond that the seeds of both sides are shuffled, and then the words of documents with hits.

Defined cases: null and empty texts, and documents or items with fewer than ``LEAST_EQUAL`` words, give no hits, since a run
that short is no evidence; empty tables give no rows; equal items are reported each; rows with the same key are
reported as one, so give columns as ``keys`` that tell rows apart where ids may repeat.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions.text import computed_once
from tessella.llm.tables import whole_text

#: Positions that count (1) and that are ignored (0).
MASKS = ("1101101", "111001001", "100101011")
#: Words compared on either side of a window, at most.
MARGIN = 24
#: Of the best run, the share and the number of words that must be equal.
LEAST_SHARE = 0.6
LEAST_EQUAL = 10
#: Most seeds of the benchmark that are broadcast, about 50 bytes each.
BROADCAST_SEEDS = 500_000


def words_of(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, words) of rows with a ``text``: the hashes of its words. They are computed once per row, out of reach of
    filters on them, so that all that follows works on an array that is there."""
    return rows.select(*keys, computed_once(F.struct(word_hashes(whole_text()).alias("words"))))


def word_hashes(text: Column) -> Column:
    words = F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+", -1), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def seeds(words: Column, place: Column, masks: tuple[str, ...]) -> Column:
    """The seeds of the windows that begin at ``place``, one per mask; null for a window beyond the end."""
    of_mask = lambda m: F.xxhash64(F.lit(m), *[F.get(words, place + i) for i, bit in enumerate(m) if bit == "1"])
    return F.array(*[F.when(place + len(m) <= F.size(words), of_mask(m)) for m in masks])


def windows(rows: DataFrame, keys: list[str], masks: tuple[str, ...]) -> DataFrame:
    """(keys, words, place, mask, seed) for rows (keys, words): every window under every mask."""
    span = min(map(len, masks))
    long = rows.filter(F.size("words") >= max(span, LEAST_EQUAL))
    each = long.select(*keys, "words", F.explode(F.sequence(F.lit(0), F.size("words") - span)).alias("place"))
    return each.select(*keys, "words", "place", F.posexplode(seeds(F.col("words"), F.col("place"), masks)).alias("mask", "seed")).filter("seed IS NOT NULL")


def hits(docs: DataFrame, items: DataFrame, keys: list[str], masks: tuple[str, ...] = MASKS, margin: int = MARGIN, broadcast_seeds: int = BROADCAST_SEEDS) -> DataFrame:
    """(keys, item_id, place, mask, and the words before, in and after the window on both sides) of equal seeds, for
    rows (keys, text) and items (item_id, text)."""
    theirs = words_of(items, ["item_id"]).select("item_id", "words", F.xxhash64("item_id", "words").alias("item"))
    of_item = theirs.dropDuplicates(["item"]).select("item", F.col("words").alias("item_words"))
    theirs = windows(theirs, ["item_id", "item"], masks).select("item_id", "item", "mask", "seed", F.col("place").alias("item_place"))
    small = theirs.limit(broadcast_seeds + 1).count() <= broadcast_seeds
    if small:  # the words of a document stay where they are and are cut out for hits alone
        mine = windows(words_of(docs, keys), keys, masks).drop("mask")
        found = mine.join(F.broadcast(theirs), "seed")
        of_item = F.broadcast(of_item)
    else:
        named = words_of(docs.withColumn("own_row", F.xxhash64(*keys, "text")), [*keys, "own_row"])
        mine = windows(named, [*keys, "own_row"], masks).drop("mask", "words")
        found = mine.join(theirs, "seed").join(named.select("own_row", "words"), "own_row")
    spans = F.get(F.array(*[F.lit(len(m)) for m in masks]), F.col("mask"))
    cut = around(F.col("words"), F.col("place"), spans, margin, "own")
    cut_out = found.select(*keys, "item_id", "item", "item_place", "place", spans.alias("span"), computed_once(F.struct(*cut)))
    both = cut_out.join(of_item, "item")
    return both.select(*keys, "item_id", "place", "span", "own_before", "own_in", "own_after", *around(F.col("item_words"), F.col("item_place"), F.col("span"), margin, "item"))


def around(words: Column, place: Column, span: Column, margin: int, name: str) -> list[Column]:
    """The words before a window, last one first, in it, and after it, at most ``margin`` of them."""
    before = F.least(place, F.lit(margin))
    cut = (F.reverse(F.slice(words, place - before + 1, before)), F.slice(words, place + 1, span), F.slice(words, place + span + 1, F.lit(margin)))
    return [c.alias(f"{name}_{part}") for c, part in zip(cut, ("before", "in", "after"), strict=True)]


def best_run(one: Column, other: Column) -> Column:
    """struct(n, equal): the shortest beginning of two sequences in which equal words most outnumber others."""
    same = F.zip_with(one, other, lambda a, b: F.coalesce(a == b, F.lit(False)).cast("int"))
    names = ("n", "equal", "best_n", "best_equal")
    start = F.struct(*[F.lit(0).alias(x) for x in names])

    def step(a: Column, x: Column) -> Column:
        n, equal = a["n"] + 1, a["equal"] + x
        better = 2 * equal - n > 2 * a["best_equal"] - a["best_n"]
        values = (n, equal, F.when(better, n).otherwise(a["best_n"]), F.when(better, equal).otherwise(a["best_equal"]))
        return F.struct(*[v.alias(x) for v, x in zip(values, names, strict=True)])

    return F.aggregate(same, start, step, lambda a: F.struct(a["best_n"].alias("n"), a["best_equal"].alias("equal")))


def verified(found: DataFrame, keys: list[str], least_share: float = LEAST_SHARE, least_equal: int = LEAST_EQUAL) -> DataFrame:
    """(keys, item_id, place, first, end, compared, equal) of hits that are an overlap."""
    within = F.aggregate(F.zip_with("own_in", "item_in", lambda a, b: (a == b).cast("int")), F.lit(0), lambda a, x: a + x)
    parts = F.struct(best_run(F.col("own_before"), F.col("item_before")).alias("left"), within.alias("within"), best_run(F.col("own_after"), F.col("item_after")).alias("right"))
    runs = found.select(*keys, "item_id", "place", "span", computed_once(parts))
    runs = runs.select(
        *keys,
        "item_id",
        "place",
        (F.col("place") - F.col("left.n")).alias("first"),
        (F.col("place") + F.col("span") + F.col("right.n")).alias("end"),
        (F.col("left.n") + F.col("span") + F.col("right.n")).alias("compared"),
        (F.col("left.equal") + F.col("within") + F.col("right.equal")).alias("equal"),
    )
    return runs.filter((F.col("equal") >= least_equal) & (F.col("equal") >= least_share * F.col("compared")))


def overlaps(docs: DataFrame, items: DataFrame, keys: list[str] | None = None, masks: tuple[str, ...] = MASKS, broadcast_seeds: int = BROADCAST_SEEDS) -> DataFrame:
    """One row for each document and item that overlap: keys, item_id, where the overlap lies in the words of the
    document, the number of places with verified hits and the best share of equal words."""
    keys = keys or ["doc_id"]
    good = verified(hits(docs.select(*keys, "text"), items, keys, masks, MARGIN, broadcast_seeds), keys)
    share = F.max(F.col("equal") / F.col("compared"))
    places = good.groupBy(*keys, "item_id", "place").agg(F.min("first").alias("first"), F.max("end").alias("end"), share.alias("share"))
    return places.groupBy(*keys, "item_id").agg(
        F.min("first").cast("long").alias("first_word"),
        F.max("end").cast("long").alias("end_word"),
        F.count(F.lit(1)).alias("n_hits"),
        F.max("share").alias("best_share"),
    )
