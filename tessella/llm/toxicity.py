"""Toxicity: expected severity by cumulative-link ordinal regression.

P(grade <= k) is a sigmoid of threshold k minus one weighted sum of the text's features, the weights being the same for
all thresholds, which are kept in order. Features are hashed words and their first letters, case and marks ignored, as indicators.
The fit is a proximal gradient descent on the negative log likelihood with an L1 term over all features of the sample, so
that most weights are exactly zero and a long text does not add up noise. How strong the term is, is chosen on rows left
aside, each in turn; it is thus weaker for larger samples. The sample is of at most ``SAMPLE`` distinct labelled rows of each
label. Toxic and clean rows weigh alike in the loss, and so do the toxic grades among themselves.

Grades come with the labelled rows. ``severity_grades`` makes three of them from labels that only say toxic or not: a
toxic text is of grade 2 if it has more distinct telling words that are found in toxic texts alone than the median of
the toxic texts, and two at least, else of grade 1. Telling words are those with a positive weight in a fit of the labels.

Defined cases: a null or empty text has no features, and its severity is that of the thresholds alone; null labels are not
learned from; without labels of two grades every severity is 0; repeated rows and null ids are scored row by row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessella.llm.features import BITS, distinct, stem_features
from tessella.llm.quality import sampled
from tessella.llm.svm import Rows, sigmoid
from tessella.llm.tables import crc, map_batches, pieces, raw, texts_of, whole_text

#: Labelled rows of each label that the model is fitted on, at most (twice that in the worst case).
SAMPLE = 3000
SIZE = 1 << BITS
#: The strongest L1 term that is tried, which is halved as long as the loss on rows left aside falls, and the term of
#: samples with too few rows to leave any aside.
STRONGEST, PENALTY = 0.02, 5e-4
#: A text is rejected if grade 1 or more is at least this likely.
REJECT = 0.5


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray


def _plain(batch: pa.RecordBatch) -> pa.Array:
    """Lower-case texts with a blank for each ASCII mark, digit or control."""
    return pc.replace_substring_regex(pc.utf8_lower(texts_of(batch)), r"[\x00-\x1f!-@\[-`{-\x7f]+", " ")


def _rows(batch: pa.RecordBatch):
    data, offsets = raw(_plain(batch))
    for low, high in pieces(offsets):
        text, feature = stem_features(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
        yield low, high - low, *distinct(text, feature)


def _indicators(index: np.ndarray, lengths: np.ndarray) -> Rows:
    """Rows whose values are all 1, which take no room."""
    return Rows(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64), index, np.broadcast_to(np.float64(1), len(index)))


def picked(rows: Rows, which: np.ndarray) -> Rows:
    """The marked ones of rows of indicators."""
    lengths = np.diff(rows.bounds)
    return _indicators(rows.index[np.repeat(which, lengths)], lengths[which])


def feature_rows(sample: DataFrame) -> tuple[Rows, np.ndarray]:
    """Indicators of words and labels of a bounded sample of rows (label, text)."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        index, counts = [], []
        for _, n, owner, feature, count in _rows(batch):
            edges = np.searchsorted(owner, np.arange(n + 1))
            index += [feature[a:b].astype("<i4").tobytes() for a, b in zip(edges, edges[1:], strict=False)]
            counts += [crc(count[a:b].astype("<i4").tobytes()) for a, b in zip(edges, edges[1:], strict=False)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(index, pa.binary()), pa.array(counts, pa.int64())], ["label", "i", "counts"])

    got = map_batches(sample, work, "label int, i binary, counts long").toArrow()
    # copies of one text say no more than one of them
    rows = sorted(set(zip(got["i"].to_pylist(), got["counts"].to_pylist(), got["label"].to_pylist(), strict=True)))
    del got
    label = np.array([y for _, _, y in rows], int)
    lengths = np.array([len(i) // 4 for i, _, _ in rows], np.int64)
    return _indicators(np.frombuffer(b"".join(i for i, _, _ in rows), "<i4"), lengths), label


def chosen_penalty(rows: Rows, toxic: np.ndarray, steps: int = 60) -> float:
    """The L1 term with the least loss on rows left aside."""
    toxic = (toxic > 0).astype(int)
    number = np.bincount(toxic, minlength=2)
    parts = min(5, int(number.min()))
    if parts < 2:
        return PENALTY
    # each part is left aside once in small samples, where each row counts, and two of them in large ones
    tried = min(parts, max(2, 6000 // len(rows)))
    part = np.zeros(len(rows), int)
    for y in (0, 1):
        part[toxic == y] = np.arange(number[y]) % parts
    split = [(picked(rows, part != k), toxic[part != k], picked(rows, part == k), toxic[part == k]) for k in range(tried)]
    models: list[Model | None] = [None] * tried
    penalty, best, least = STRONGEST, STRONGEST, np.inf
    while penalty > 1e-6:
        loss = 0.0
        for k, (learned, y, aside, want) in enumerate(split):
            models[k] = fit_grades(learned, y, penalty, steps, models[k])
            p = np.clip(expected(models[k], aside.times(models[k].weights))[1], 1e-9, 1 - 1e-9)
            loss -= np.log(p[want == 1]).mean() + np.log(1 - p[want == 0]).mean()
        if loss < least:
            best, least = penalty, loss
        elif penalty < best / 2:  # it has risen twice
            break
        penalty /= 2
    return best


def severity_grades(rows: Rows, toxic: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """Grades 0, 1 and 2 from words and labels 0 and 1."""
    grade = (toxic == 1).astype(int)
    if not grade.any() or grade.all():
        return grade
    terms = (fit_grades(rows, grade, penalty, 100).weights > 0).astype(float)
    terms[rows.spread(1.0 - grade, SIZE) > 0] = 0.0
    number = rows.times(terms)
    grade[(grade == 1) & (number > max(np.median(number[grade == 1]), 1))] = 2
    return grade


def _ordered(free: np.ndarray) -> np.ndarray:
    """Thresholds from free numbers: the first, then positive steps."""
    return np.cumsum(np.concatenate([free[:1], np.exp(np.clip(free[1:], -10, 10))]))


def fit_grades(rows: Rows, grade: np.ndarray, penalty: float = PENALTY, steps: int = 300, start: Model | None = None) -> Model:
    """Weights and thresholds of rows with grades 0 to K, by descent with momentum from ``start``; grade 0 and all
    others together weigh alike in the loss, and so do the others among themselves."""
    top = int(grade.max()) if len(grade) else 0
    if top < 1 or len(set(grade.tolist())) < 2:
        return Model(np.zeros(SIZE), np.zeros(0))
    kept = np.unique(rows.index)
    at = np.searchsorted(kept, rows.index).astype(np.int32)
    owner = np.repeat(np.arange(len(rows), dtype=np.int32), np.diff(rows.bounds))
    number = np.bincount(grade, minlength=top + 1)
    weight = 1.0 / np.maximum(number, 1)
    weight[1:] /= max((number[1:] > 0).sum(), 1)
    each = weight[grade] / weight[grade].sum()
    share = np.clip(np.cumsum(number / number.sum())[:-1], 1e-3, 1 - 1e-3)
    cut = start.thresholds if start and len(start.thresholds) == top else np.log(share / (1 - share))
    free = np.concatenate([cut[:1], np.log(np.maximum(np.diff(cut), 0.1))])
    # weights first, then the thresholds' free numbers, in one vector
    found = np.concatenate([start.weights[kept] if start else np.zeros(len(kept)), free])
    mean, square, m = np.zeros_like(found), np.zeros_like(found), len(kept)
    for step in range(1, steps + 1):
        weights, free = found[:m], found[m:]
        cut = np.concatenate([[-40.0], _ordered(free), [40.0]])
        z = np.bincount(owner, weights[at], len(rows))
        above, below = sigmoid(cut[grade + 1] - z), sigmoid(cut[grade] - z)
        within = np.maximum(above - below, 1e-12)
        rise_above, rise_below = above * (1 - above) / within, below * (1 - below) / within
        slope = np.bincount(at, (each * (rise_above - rise_below))[owner], m)
        by_cut = (np.bincount(grade + 1, -each * rise_above, top + 2) + np.bincount(grade, each * rise_below, top + 2))[1:-1]
        later = np.cumsum(by_cut[::-1])[::-1]
        by_free = np.concatenate([later[:1], later[1:] * np.exp(np.clip(free[1:], -10, 10))])
        change = np.concatenate([slope, by_free])
        mean = 0.9 * mean + 0.1 * change
        square = 0.99 * square + 0.01 * change**2
        rate = 0.03 / (np.sqrt(square / (1 - 0.99**step)) + 1e-6)
        found = found - rate * mean / (1 - 0.9**step)
        found[:m] = np.sign(found[:m]) * np.maximum(np.abs(found[:m]) - rate[:m] * penalty, 0)
    weights = np.zeros(SIZE)
    weights[kept] = found[:m]
    return Model(weights, _ordered(found[m:]))


def fit(labelled: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from rows (label int: toxic 0/1, text)."""
    labelled = labelled.filter(F.col("label").isin(0, 1)).select(F.col("label").cast("int").alias("label"), whole_text().alias("text"))
    rows, label = feature_rows(sampled(labelled, sample))
    penalty = chosen_penalty(rows, label)
    return fit_grades(rows, severity_grades(rows, label, penalty), penalty)


def expected(model: Model, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(expected severity, probability of grade 1 or more)."""
    if not len(model.thresholds):
        return np.zeros(len(z)), np.zeros(len(z))
    above = sigmoid(z[:, None] - model.thresholds[None, :])
    return above.sum(1), above[:, 0]


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, severity, p_toxic, grade, toxic) of rows (doc_id, text)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return with_severity(rows, model, ("severity", "p_toxic", "grade", "toxic")).drop("text")


def with_severity(docs: DataFrame, model: Model, names: tuple[str, str, str, str]) -> DataFrame:
    """All columns of rows with a ``text``, and four more of the given names: expected severity, probability of
    grade 1 or more, rounded severity, and whether the text is rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        model, severity, p = shared.value, np.zeros(batch.num_rows), np.zeros(batch.num_rows)
        for low, n, owner, feature, _ in _rows(batch):
            z = np.bincount(owner, model.weights[feature], n)
            severity[low : low + n], p[low : low + n] = expected(model, z)
        grade = np.clip(np.rint(severity), 0, len(model.thresholds)).astype(np.int32)
        extra = [pa.array(severity), pa.array(p), pa.array(grade), pa.array(p >= REJECT)]
        return pa.RecordBatch.from_arrays([*batch.columns, *extra], [*batch.schema.names, *names])

    schema = StructType(list(docs.schema.fields))
    for name, kind in zip(names, ("double", "double", "integer", "boolean"), strict=True):
        schema = schema.add(name, kind)
    return map_batches(docs, work, schema)
