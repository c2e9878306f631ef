"""Quality rules as a learned decision list, in DataFrame operations only.

The list is found by sequential covering. A rule is a conjunction of thresholds on statistics of a text, such as
``symbol_share >= 0.012 AND n_words < 3000``. It is grown on two thirds of the labelled rows by adding the threshold of
the largest information gain until it covers no good row, then pruned on the other third by taking away its last
conditions while that raises the difference of bad and good rows over those covered. Rows that it covers go, and the next
rule is grown on the rest, until a rule is not good enough on the rows it was not grown on. The rules, in order, become
one conditional expression of Spark.

Statistics are counted on a fixed grid: shares by thousandths, quantities by 1/32 of a doubling. So a step of growth is one
aggregation of all labelled rows into at most a few thousand counts (feature, level, label), from which every threshold is
judged; no rows are sampled or collected, and the counts that reach the driver do not grow with the rows. If several
neighbouring thresholds split the rows alike, the middle one is taken.

Defined cases: null labels and those other than 0 and 1 are not learned from; several labels of a document each count;
without rows of both labels, or without a rule that holds on the rows left aside, the list is empty and rejects nothing;
null statistics meet no condition; equal rows fall into the same third.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.llm.tables import store

#: Steps of a quantity's level within a doubling, and of a share's within 1.
STEPS, PARTS = 32, 1000
#: Conditions of a rule and rules of a list, at most.
MOST_CONDITIONS, MOST_RULES = 4, 24
#: Of the rows left aside that a rule covers, the share that must be bad, and the bad rows that there must be.
LEAST_PRECISION, LEAST_BAD = 0.9, 2

QUANTITIES = ("n_words", "mean_word_chars", "words_a_line")
SHARES = ("symbol_share", "digit_share", "capital_share", "mark_share", "dup_line_share", "distinct_share", "repeat_share")
FEATURES = QUANTITIES + SHARES


def features() -> list[Column]:
    """The columns FEATURES of rows of counts."""
    over = lambda a, b: F.coalesce(F.col(a) / F.nullif(F.col(b), F.lit(0)), F.lit(0.0))
    return [
        F.col("n_words").cast("double").alias("n_words"),
        over("word_chars", "n_words").alias("mean_word_chars"),
        over("n_words", "n_lines").alias("words_a_line"),
        over("n_symbols", "n_chars").alias("symbol_share"),
        over("n_digits", "n_chars").alias("digit_share"),
        over("n_capitals", "n_chars").alias("capital_share"),
        over("n_marks", "n_chars").alias("mark_share"),
        over("n_dup_lines", "n_lines").alias("dup_line_share"),
        over("n_distinct_words", "n_words").alias("distinct_share"),
        over("n_repeat_words", "n_words").alias("repeat_share"),
    ]


def level(name: str) -> Column:
    value = F.col(name)
    return F.floor(F.log2(value + 1) * STEPS if name in QUANTITIES else value * PARTS).cast("int")


def value_at(name: str, at: int) -> float:
    """The least value of a level."""
    return round(2 ** (at / STEPS) - 1, 4) if name in QUANTITIES else at / PARTS


@dataclass(frozen=True)
class Condition:
    """``name`` is at least (``above``) or below the least value of a level."""

    name: str
    above: bool
    at: int

    def on_levels(self) -> Column:
        return F.col(self.name) >= self.at if self.above else F.col(self.name) < self.at

    def on_values(self) -> Column:
        value = value_at(self.name, self.at)
        return F.coalesce(F.col(self.name) >= value if self.above else F.col(self.name) < value, F.lit(False))

    def __str__(self) -> str:
        return f"{self.name} {'>=' if self.above else '<'} {value_at(self.name, self.at)}"


@dataclass
class DecisionList:
    """Rules that reject, in order, each with its rows left aside: (bad, good)."""

    rules: list[tuple[Condition, ...]] = field(default_factory=list)
    support: list[tuple[int, int]] = field(default_factory=list)

    def number(self) -> Column:
        """The first rule that a row of features meets, from 1; null if it meets none."""
        found = F.lit(None).cast("int")
        for k in range(len(self.rules), 0, -1):
            found = F.when(_all(c.on_values() for c in self.rules[k - 1]), F.lit(k)).otherwise(found)
        return found

    def __str__(self) -> str:
        lines = [f"{k}. reject if {' and '.join(map(str, r))}  ({bad} bad, {good} good left aside)" for k, (r, (bad, good)) in enumerate(zip(self.rules, self.support, strict=True), 1)]
        return "\n".join([*lines, "else keep"])


def _all(conditions) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def _gain(bad: int, good: int, of_bad: int, of_good: int) -> float:
    if not bad:
        return 0.0
    return bad * (math.log2(bad / (bad + good)) - math.log2(of_bad / (of_bad + of_good)))


def best_condition(counts: dict[str, dict[int, tuple[int, int]]]) -> Condition | None:
    """The threshold of the largest gain; ``counts`` holds (bad, good) rows of each level of each feature."""
    best, most = None, 1e-9
    for name in FEATURES:
        levels = sorted(counts.get(name, {}).items())
        total = [sum(c[k] for _, c in levels) for k in (0, 1)]
        below = [0, 0]
        for (low, count), (high, _) in zip(levels, levels[1:], strict=False):
            below = [below[0] + count[0], below[1] + count[1]]
            for above in (True, False):
                bad, good = (total[0] - below[0], total[1] - below[1]) if above else below
                if (gain := _gain(bad, good, *total)) > most:
                    # every threshold after ``low``, up to ``high``, splits these rows alike
                    best, most = Condition(name, above, (low + 1 + high) // 2), gain
    return best


def _counts(rows: DataFrame) -> dict[str, dict[int, tuple[int, int]]]:
    each = rows.select("bad", F.posexplode(F.array(*FEATURES)).alias("feature", "level"))
    found: dict[str, dict[int, tuple[int, int]]] = {}
    for r in each.groupBy("feature", "level").agg(F.sum("bad").alias("b"), F.count(F.lit(1)).alias("n")).collect():
        found.setdefault(FEATURES[r.feature], {})[r.level] = (r.b, r.n - r.b)
    return found


def grown(rows: DataFrame) -> tuple[Condition, ...]:
    rule: tuple[Condition, ...] = ()
    while len(rule) < MOST_CONDITIONS:
        counts = _counts(rows.filter(_all(c.on_levels() for c in rule)))
        total = [sum(c[k] for c in counts.get(FEATURES[0], {}).values()) for k in (0, 1)]
        if not total[0] or not total[1] or (found := best_condition(counts)) is None:
            break
        rule += (found,)
    return rule


def pruned(rule: tuple[Condition, ...], rows: DataFrame) -> tuple[tuple[Condition, ...], int, int]:
    """The shortest beginning of a rule with the best (bad - good) / (bad + good), and its (bad, good) rows."""
    aggregates = []
    for k in range(1, len(rule) + 1):
        hit = _all(c.on_levels() for c in rule[:k])
        aggregates += [F.count_if(hit & (F.col("bad") == 1)).alias(f"b{k}"), F.count_if(hit & (F.col("bad") == 0)).alias(f"g{k}")]
    got = rows.agg(*aggregates).first()
    worth = [((got[f"b{k}"] - got[f"g{k}"]) / max(got[f"b{k}"] + got[f"g{k}"], 1), -k) for k in range(1, len(rule) + 1)]
    k = -max(worth)[1]
    return rule[:k], got[f"b{k}"], got[f"g{k}"]


def fit(labelled: DataFrame, least_precision: float = LEAST_PRECISION, most_rules: int = MOST_RULES) -> DecisionList:
    """A list from rows (label 0 bad / 1 good, FEATURES)."""
    levels = [level(name).alias(name) for name in FEATURES]
    part = F.pmod(F.xxhash64(*FEATURES), F.lit(3)).alias("part")
    rows = labelled.filter(F.col("label").isin(0, 1)).select((1 - F.col("label")).cast("long").alias("bad"), part, *levels)
    rows = store(rows, "rule-levels")
    out = DecisionList()
    while len(out.rules) < most_rules:
        rule = grown(rows.filter("part < 2"))
        if not rule:
            break
        rule, bad, good = pruned(rule, rows.filter("part = 2"))
        if bad < LEAST_BAD or bad < least_precision * (bad + good):
            break
        out.rules.append(rule)
        out.support.append((bad, good))
        rows = rows.filter(~_all(c.on_levels() for c in rule))
    return out
