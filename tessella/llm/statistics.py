"""Interpretable statistics of whole texts, in DataFrame functions only.

Words are runs of characters other than ASCII white space. Characters are code points. A text is read by one
translation, which turns each class of characters (symbols, digits, capitals, marks, white space) into one character of
that class, so that a class is counted by leaving that character out.

``n_repeat_words`` counts the words that lie in a window of ``WINDOW`` words which stands in the text twice or more.
Windows are 64-bit hashes of their words' hashes. A text whose windows all differ, as nearly all do, is done after one
pass through a hash set; else the windows are sorted with their places, and the places of equal neighbours, in order,
give the words that they cover. Both are row-local and grow with the text as n log n, whatever repeats.

Defined cases: a null text is an empty one; an empty text has zero words, lines and shares.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.functions.text import computed_once, let
from tessella.llm.tables import whole_text

WINDOW = 8
SPACES = "\x20\t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
DIGITS = "0123456789"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MARKS = ".,;:!?"

COUNTS = ("n_chars", "n_words", "word_chars", "n_symbols", "n_digits", "n_capitals", "n_marks", "n_lines", "n_dup_lines", "n_distinct_words", "n_repeat_words")


def _classed(text: Column) -> Column:
    classes = (SPACES, SYMBOLS, DIGITS, CAPITALS, MARKS)
    return F.translate(text, "".join(classes), "".join(c[0] * len(c) for c in classes))


def _number_of(kind: str) -> Column:
    return F.length("classed") - F.length(F.replace(F.col("classed"), F.lit(kind[0]), F.lit("")))


def word_hashes(text: Column) -> Column:
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+", -1), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def window_hashes(hashes: Column, window: int = WINDOW) -> Column:
    """One hash for each run of ``window`` words, in order. ``hashes`` must be a column that is there."""
    run = lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(window)])
    none = F.array().cast("array<bigint>")
    return F.when(F.size(hashes) < window, none).otherwise(F.transform(F.sequence(F.lit(0), F.size(hashes) - window), run))


def covered(windows: Column, window: int = WINDOW) -> Column:
    """Words in windows that occur twice or more. ``windows`` must be a column that is there."""

    def union(places: Column) -> Column:
        each = F.transform(places, lambda p, i: F.least(F.lit(window), F.coalesce(F.get(places, i + 1) - p, F.lit(window))))
        return F.aggregate(each, F.lit(0).cast("long"), lambda a, x: a + x)

    def repeated(ordered: Column) -> Column:
        same = lambda e, i: F.coalesce(F.get(ordered, i)["h"] == e["h"], F.lit(False))
        found = F.filter(ordered, lambda e, i: same(e, i - 1) | same(e, i + 1))
        return let(F.array_sort(F.transform(found, lambda e: e["p"])), union)

    placed = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(let(placed, repeated))


def statistics(docs: DataFrame, keys: list[str], text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """The keys and ``COUNTS`` of each row."""
    text = docs.select(*[docs[k] for k in keys], whole_text(docs[text_col]).alias("text"))
    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    first = F.struct(_classed(F.col("text")).alias("classed"), word_hashes(F.col("text")).alias("hashes"), let(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("d"))).alias("lines"))
    read = text.select(*keys, computed_once(first))
    counts = [
        F.length("classed").alias("n_chars"),
        F.size("hashes").alias("n_words"),
        (F.length("classed") - _number_of(SPACES)).alias("word_chars"),
        *[_number_of(kind).alias(name) for kind, name in ((SYMBOLS, "n_symbols"), (DIGITS, "n_digits"), (CAPITALS, "n_capitals"), (MARKS, "n_marks"))],
        F.col("lines.n").alias("n_lines"),
        (F.col("lines.n") - F.col("lines.d")).alias("n_dup_lines"),
        F.size(F.array_distinct("hashes")).alias("n_distinct_words"),
    ]
    counted = read.select(*keys, computed_once(F.struct(*counts, window_hashes(F.col("hashes"), window).alias("windows"))))
    out = counted.withColumn("n_repeat_words", covered(F.col("windows"), window))
    return out.select(*keys, *[F.col(c).cast("long").alias(c) for c in COUNTS])
