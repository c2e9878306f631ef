"""Quality scores: naive Bayes support vectors.

Features are indicators of hashed n-grams: words, and runs of two or three word looks. The log-count ratio of a feature
compares the shares of its indicator in the two classes, counted over all labelled rows that may be learned from. The
indicators are scaled by these ratios, and a linear model with hinge loss is fitted to the scaled rows by dual
coordinate descent. Counts come from a Spark aggregation over a table of fixed size (2**18 features); the linear model is
fitted on at most ``SAMPLE`` labelled rows of each class, whose margins on a fifth left aside calibrate the score.

Defined cases: a null or empty text has no features and gets the score of the bias; null labels and labels of
documents that are not there are not learned from; if a document has several labels, each counts; without labels of both
classes the score is 0.5; repeated rows and null ids are scored row by row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.features import BITS, distinct, style_features
from tessella.llm.svm import Rows, calibrate, sigmoid, train
from tessella.llm.tables import map_batches, pieces, raw, texts_of, whole_text

#: Labelled rows of each class that the linear model is fitted on, at most (twice that in the worst case).
SAMPLE = 3000
SIZE = 1 << BITS


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    slope: float
    shift: float


def _rows(batch: pa.RecordBatch):
    """(first text, texts, owner, feature) of each vectorised step over a batch."""
    data, offsets = raw(texts_of(batch))
    for low, high in pieces(offsets):
        text, feature = style_features(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
        owner, feature, _ = distinct(text, feature)
        yield low, high - low, owner, feature


def class_counts(labelled: DataFrame) -> np.ndarray:
    """Rows of each class (0, 1) in which a feature occurs, as an array [2, 2**18]; of rows (label, text)."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        label, both = np.array(batch.column(0).to_pylist()), np.zeros((2, SIZE), np.int64)
        for low, n, owner, feature in _rows(batch):
            np.add.at(both, (label[low : low + n][owner], feature), 1)
        kept = np.flatnonzero(both.any(0))
        return pa.RecordBatch.from_arrays([pa.array(kept), pa.array(both[0, kept]), pa.array(both[1, kept])], ["feature", "zeros", "ones"])

    counts = map_batches(labelled, work, "feature long, zeros long, ones long", rows=4000)
    total = counts.groupBy("feature").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones")).toArrow()
    out = np.zeros((2, SIZE), np.int64)
    out[:, total["feature"].to_numpy()] = [total["zeros"].to_numpy(), total["ones"].to_numpy()]
    return out


def log_count_ratios(counts: np.ndarray, smoothing: float = 1.0) -> np.ndarray:
    share = counts + smoothing
    return np.log(share[1] / share[1].sum()) - np.log(share[0] / share[0].sum())


def sampled(labelled: DataFrame, most: int) -> DataFrame:
    """About ``most`` rows of each class at most, by a hash of the text."""
    sizes = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    place = F.pmod(F.xxhash64("text"), F.lit(1_000_000)) / 1e6
    keep = F.lit(False)
    for label, n in sizes.items():
        keep = keep | ((F.col("label") == label) & (place < most / n))
    return labelled.filter(keep).limit(2 * most * max(1, len(sizes)))


def feature_rows(sample: DataFrame) -> tuple[Rows, np.ndarray]:
    """Indicators and labels of a bounded sample."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for _, n, owner, feature in _rows(batch):
            edges = np.searchsorted(owner, np.arange(n + 1))
            rows += [feature[a:b].astype("<i4").tobytes() for a, b in zip(edges, edges[1:], strict=False)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], ["label", "features"])

    got = map_batches(sample, work, "label int, features binary").toArrow()
    pairs = sorted(zip(got["features"].to_pylist(), got["label"].to_pylist(), strict=True))  # the same order in every run
    index = [np.frombuffer(f, "<i4").astype(np.int64) for f, _ in pairs]
    return Rows.of([(i, np.ones(len(i))) for i in index]), np.array([y for _, y in pairs], int)


def fit(labelled: DataFrame, sample: int = SAMPLE, cost: float = 0.1) -> Model:
    """A model from rows (label int 0/1, text)."""
    labelled = labelled.filter(F.col("label").isin(0, 1)).select(F.col("label").cast("int").alias("label"), whole_text().alias("text"))
    ratio = log_count_ratios(class_counts(labelled))
    rows, label = feature_rows(sampled(labelled, sample))
    if len(set(label.tolist())) < 2:
        return Model(np.zeros(SIZE), 0.0, 1.0, 0.0)
    rows.value = rows.value * ratio[rows.index]
    norm = np.sqrt(np.maximum(Rows(rows.bounds, rows.index, rows.value**2).times(np.ones(SIZE)), 1e-12))
    rows.value = rows.value / np.repeat(norm, np.diff(rows.bounds))
    aside = np.arange(len(rows)) % 5 == 0
    weights, bias = train(rows.pick(np.flatnonzero(~aside)), label[~aside] == 1, SIZE, cost * 10)
    margin = rows.pick(np.flatnonzero(aside)).times(weights) + bias
    return Model(np.stack([weights * ratio, ratio**2]), bias, *calibrate(margin, label[aside] == 1))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of rows (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        model, out = shared.value, np.zeros(batch.num_rows)
        if model.weights.ndim == 2:
            for low, n, owner, feature in _rows(batch):
                total = np.bincount(owner, model.weights[0][feature], n)
                norm = np.sqrt(np.maximum(np.bincount(owner, model.weights[1][feature], n), 1e-12))
                out[low : low + n] = total / norm
        result = sigmoid(model.slope * (out + model.bias) + model.shift)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(result)], ["doc_id", "score"])

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")), work, "doc_id long, score double")
