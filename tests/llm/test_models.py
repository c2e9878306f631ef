"""Quality, toxicity and language: held-out accuracy on the given tables, and the defined cases."""

import numpy as np
import pytest
from helpers import clashing, documents, prose
from pyspark.sql import functions as F

from tessella.llm import features, language, quality, svm, toxicity
from tessella.llm.queries import REGISTRY

SF = "/root/testdata/sf0.01"
ODD = [(1, None), (2, ""), (3, "!!! 123"), (4, "x " * 50_000), (4, "x " * 50_000), (None, "word")]


def test_machine_separates_what_can_be_separated():
    rows = svm.Rows.of([(np.array([i % 2, 2]), np.ones(2)) for i in range(40)])
    weights, bias = svm.train(rows, np.arange(40) % 2 == 1, 3)
    assert ((rows.times(weights) + bias > 0) == (np.arange(40) % 2 == 1)).all()
    weights, bias = svm.train(rows, np.ones(40, bool), 3)
    assert not weights.any() and bias == 1


def test_dual_descent_reaches_the_best_loss():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 3))
    y = (x @ [1, -2, 0.5] + 0.8 * rng.normal(size=60)) > 0
    rows = svm.Rows.of([(np.arange(3), r) for r in x])
    w, b = svm.train(rows, y, 3, cost=0.5, epochs=2000)
    sign = np.where(y, 1, -1)
    share = np.where(y, 60 / (2 * y.sum()), 60 / (2 * (~y).sum()))
    loss = lambda w, b: 0.5 * (w @ w + b * b) + 0.5 * (share * np.maximum(0, 1 - sign * (x @ w + b))).sum()
    best = loss(w, b)
    assert all(best <= loss(w + d[:3], b + d[3]) + 1e-3 for d in 0.05 * rng.normal(size=(300, 4)))


def test_quality_held_out(spark):
    scores = REGISTRY["op2_quality_nbsvm"](spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = scores.filter("held_out").join(labels, "doc_id").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95
    assert scores.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_toxicity_of_labelled(spark):
    larger = "/root/testdata/sf0.1"  # a few dozen toxic texts are too few to learn from
    found = REGISTRY["op4_toxicity_ordinal"](spark, larger)
    rows = found.join(spark.read.parquet(f"{larger}/labels.parquet").withColumnRenamed("toxic", "label"), "doc_id").collect()
    assert np.mean([r.toxic for r in rows if r.label == 0]) < 0.01
    assert np.mean([r.toxic for r in rows if r.label == 1]) > 0.9
    assert all(0 <= r.severity <= 2 for r in rows)


def test_toxicity_of_rows_left_aside(spark):
    """Fitted on four fifths of the labelled documents; judged on texts of the others that the fit has not seen."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = docs.join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").select("doc_id", "text", "lang", F.col("toxic").alias("label")).filter("label IS NOT NULL")
    aside = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = toxicity.fit(rows.filter(~aside))
    unseen = rows.filter(aside).join(rows.filter(~aside).select("text"), "text", "left_anti")
    judged = toxicity.with_severity(unseen, model, ("severity", "p", "grade", "rejected")).select("lang", "label", "rejected").collect()
    assert np.mean([r.rejected for r in judged if r.label == 1]) > 0.85
    assert np.mean([r.rejected for r in judged if r.label == 0]) < 0.02
    by = {lang: [r.rejected for r in judged if r.label == 1 and r.lang == lang] for lang in {r.lang for r in judged}}
    print("found of toxic texts left aside:", {k: (sum(v), len(v)) for k, v in by.items()}, "rejected of clean:", sum(r.rejected for r in judged if r.label == 0), sum(r.label == 0 for r in judged))


def test_thresholds_share_weights_and_stay_in_order():
    rng = np.random.default_rng(3)
    rows = svm.Rows.of([(np.array([k]), np.ones(1)) for k in rng.integers(0, 4, 400)])
    grade = np.clip(rows.index, 0, 3)
    model = toxicity.fit_grades(rows, grade, steps=600)
    assert (np.diff(model.thresholds) > 0).all()
    severity, _ = toxicity.expected(model, model.weights[:4])
    assert (np.diff(severity) > 0).all() and np.abs(severity - np.arange(4)).max() < 0.6


def test_every_telling_feature_gets_a_weight():
    """A hundred words, each in its own six toxic texts: none may lose its weight to a rank."""
    rows = [(np.array([k]), np.ones(1)) for k in range(100) for _ in range(6)] + [(np.array([900 + i % 40]), np.ones(1)) for i in range(3000)]
    label = np.repeat([1, 0], [600, 3000])
    model = toxicity.fit_grades(svm.Rows.of(rows), label, steps=300)
    assert (model.weights[:100] > 0).all()


def test_toxicity_of_few_labelled(spark):
    """Fifty toxic texts, fifteen of them not English: those, too, are learned from."""
    found = REGISTRY["op4_toxicity_ordinal"](spark, SF).select("doc_id", "toxic")
    labels = spark.read.parquet(f"{SF}/labels.parquet").withColumnRenamed("toxic", "label")
    rows = found.join(labels, "doc_id").join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r.toxic for r in rows if r.label == 1 and r.lang != "en"]) > 0.7
    assert np.mean([r.toxic for r in rows if r.label == 1]) > 0.85
    assert np.mean([r.toxic for r in rows if r.label == 0]) < 0.05


def test_language_held_out(spark):
    found = REGISTRY["op5_language_hierarchy"](spark, SF).filter("held_out")
    rows = found.join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id").collect()
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.98


def _langs(spark):
    words = {"en": "the of and with this", "de": "der und nicht das ein", "fr": "le et pas une dans", "es": "el y no una con"}
    rows = [(10 * k + i, f"{w} {p}", lang) for k, (lang, w) in enumerate(words.items()) for i, p in enumerate(prose(8, k, 4))]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_language_defined_cases(spark):
    model = language.fit(_langs(spark).union(spark.createDataFrame([(99, "null", None)], "doc_id long, text string, lang string")))
    got = language.predict(clashing(documents(spark, ODD)), model).collect()
    assert [(r.lang_pred, r.score) for r in got if r.doc_id in (1, 2, 3)] == [("und", 0.0)] * 3
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert {"germanic", "romance"} == set(model.families)
    nothing = language.fit(_langs(spark).limit(0))
    assert {r.lang_pred for r in language.predict(documents(spark, ODD), nothing).collect()} == {"und"}
    one = language.fit(_langs(spark).filter("lang = 'en'"))
    assert {r.lang_pred for r in language.predict(documents(spark, ODD), one).collect()} == {"und", "en"}
    assert language.predict(documents(spark, []), model).count() == 0


@pytest.mark.parametrize("labels", [[], [1], [0, 1]])
def test_models_of_few_labels(spark, labels):
    rows = [(y, "bad words here" if y else "good words there") for y in labels for _ in range(6)] + [(None, "x"), (1 if labels else None, None)]
    labelled = spark.createDataFrame(rows, "label int, text string")
    docs = clashing(documents(spark, ODD))
    scores = quality.score(docs, quality.fit(labelled)).collect()
    assert len(scores) == len(ODD) and all(0 <= r.score <= 1 for r in scores)
    found = toxicity.score(docs, toxicity.fit(labelled)).collect()
    assert len(found) == len(ODD) and all(r.severity >= 0 for r in found)
    assert quality.score(documents(spark, []), quality.fit(labelled)).count() == 0


def test_class_counts_are_of_all_rows(spark):
    rows = [(i % 2, t) for i, t in enumerate(prose(300, 2, 20))]
    counts = quality.class_counts(spark.createDataFrame(rows, "label int, text string").repartition(7))
    want = np.zeros((2, quality.SIZE), int)
    for y, t in rows:
        data = np.frombuffer(t.encode(), np.uint8)
        _, feature = features.style_features(data, np.array([0, len(data)]))
        want[y, np.unique(feature)] += 1
    assert (counts == want).all()
    assert F is not None
