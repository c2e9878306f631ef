"""Text statistics, decision lists and clustering against plain versions."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
from helpers import clashing, documents, prose
from pyspark.sql import functions as F

from tessella.llm import centroids, decision_list, statistics
from tessella.llm.queries import REGISTRY

SF = "/root/testdata/sf0.01"


def plain_counts(text):
    t = text or ""
    w = re.findall("[^\x20\x09-\x0d]+", t)
    seen = {}
    for i in range(len(w) - 7):
        seen.setdefault(tuple(w[i : i + 8]), []).append(i)
    covered = {k for v in seen.values() if len(v) > 1 for i in v for k in range(i, i + 8)}
    lines = [x for x in t.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))


ODD = [None, "", " \t\n\x0b\x0c\r", "a", "a b c d e f g h", "a b c d e f g h " * 3, "x " * 5000, "ab\ncd\n\nab\n \nab\r\nab", "#*$%&|<> # Ab 1.5!", "   x yé\U0001f600 " * 4, "q" * 100_000, "\n".join(["same line here"] * 300)]


def test_counts_of_odd_texts(spark):
    rng = random.Random(1)
    texts = ODD + [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 120))) for _ in range(60)] + prose(5) + [" ".join(prose(40, 3)) * 3]
    got = statistics.statistics(clashing(documents(spark, list(enumerate(texts)))), ["doc_id"]).collect()
    assert {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got} == {i: plain_counts(t) for i, t in enumerate(texts)}
    other = {r.doc_id: (r.n_chars, r.n_digits, r.n_capitals, r.n_marks, r.n_distinct_words) for r in got}
    plain = lambda t: (len(t), len(re.findall("[0-9]", t)), len(re.findall("[A-Z]", t)), len(re.findall("[.,;:!?]", t)), len(set(re.findall("[^\x20\x09-\x0d]+", t))))
    assert other == {i: plain(t or "") for i, t in enumerate(texts)}
    assert not statistics.statistics(documents(spark, []), ["doc_id"]).count()


def labelled(spark, rows):
    """Rows (label, n_words, symbol_share) with all other features 0."""
    df = spark.createDataFrame(rows, "label int, n_words double, symbol_share double")
    return df.select("label", *[F.col(n) if n in ("n_words", "symbol_share") else F.lit(0.0).alias(n) for n in decision_list.FEATURES])


def test_list_finds_the_rules_that_made_the_labels(spark):
    rng = random.Random(2)
    rows = [(rng.uniform(0, 4000), rng.random()) for _ in range(3000)]
    bad = lambda n, s: s >= 0.7 or (n < 500 and s < 0.2)
    found = decision_list.fit(labelled(spark, [(0 if bad(n, s) else 1, n, s) for n, s in rows]))
    assert found.rules[0][0].name == "symbol_share" and found.rules[0][0].above and abs(found.rules[0][0].at - 700) < 8
    assert {(c.name, c.above) for c in found.rules[1]} == {("n_words", False), ("symbol_share", False)}
    fresh = [(rng.uniform(0, 4000), rng.random()) for _ in range(2000)]
    judged = labelled(spark, [(0 if bad(n, s) else 1, n, s) for n, s in fresh]).select("label", found.number().alias("rule")).collect()
    assert np.mean([(r.rule is not None) == (r.label == 0) for r in judged]) > 0.97
    assert "else keep" in str(found) and "reject if symbol_share >= 0." in str(found)


def plain_best(rows):
    """The best single threshold by trying all of them, as the share of information gained."""
    P, N = sum(b for b, *_ in rows), sum(1 - b for b, *_ in rows)
    best = 0.0
    for k in range(1, len(rows[0])):
        for at in {r[k] for r in rows}:
            for above in (True, False):
                hit = [r for r in rows if (r[k] >= at) == above]
                p = sum(r[0] for r in hit)
                if p:
                    best = max(best, p * (math.log2(p / len(hit)) - math.log2(P / (P + N))))
    return best


@pytest.mark.parametrize("seed", range(5))
def test_threshold_of_the_largest_gain(seed):
    rng = random.Random(seed)
    rows = [(rng.randint(0, 1), rng.randint(0, 9), rng.randint(0, 9)) for _ in range(80)]
    names = decision_list.FEATURES[:2]
    counts = {n: {} for n in names}
    for r in rows:
        for n, v in zip(names, r[1:], strict=True):
            b, g = counts[n].get(v, (0, 0))
            counts[n][v] = (b + r[0], g + 1 - r[0])
    found = decision_list.best_condition(counts)
    column = names.index(found.name) + 1
    hit = [r for r in rows if (r[column] >= found.at) == found.above]
    p, all_bad = sum(r[0] for r in hit), sum(r[0] for r in rows)
    assert p * (math.log2(p / len(hit)) - math.log2(all_bad / len(rows))) == pytest.approx(plain_best(rows))


def test_middle_of_thresholds_that_split_alike():
    counts = {"n_words": {0: (0, 10), 100: (10, 0)}}
    assert decision_list.best_condition(counts) == decision_list.Condition("n_words", True, 50)


def test_nothing_to_learn(spark):
    for rows in ([], [(1, 5.0, 0.1)] * 9, [(0, 5.0, 0.1)] * 9, [(None, 1.0, 0.1), (2, 1.0, 0.9)], [(0, 5.0, 0.1), (1, 5.0, 0.1)] * 20):
        rules = decision_list.fit(labelled(spark, rows))
        assert not rules.rules
        assert not labelled(spark, [(1, 0.0, 1.0)]).select(rules.number().alias("r")).filter("r IS NOT NULL").count()


def test_null_statistics_meet_no_condition(spark):
    rules = decision_list.DecisionList([(decision_list.Condition("symbol_share", False, 500),)], [(2, 0)])
    got = spark.createDataFrame([(None,), (0.2,), (0.9,)], "symbol_share double").select(rules.number().alias("r")).collect()
    assert [r.r for r in got] == [None, 1, None]


def test_quality_rules_held_out(spark):
    """Learned from four fifths of the labelled documents, judged on the others."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    counted = statistics.statistics(docs, ["doc_id"]).join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet").withColumnRenamed("quality", "label"), "doc_id")
    counted = counted.filter("n_words >= 20 AND 100 * n_repeat_words <= 30 * n_words").select("label", "doc_id", *decision_list.features()).cache()
    rules = decision_list.fit(counted.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0))
    rows = counted.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0).select("label", rules.number().alias("rule")).collect()
    assert np.mean([r.rule is not None for r in rows if r.label == 0]) > 0.9
    assert np.mean([r.rule is not None for r in rows if r.label == 1]) < 0.005


def test_rules_query_is_native_and_whole(spark):
    got = REGISTRY["op11_decision_lists"](spark, SF)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = got.collect()
    assert {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows} == {i: plain_counts(t) for i, t in texts.items()}
    for r in rows:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept == (r.rule is None) and (not r.base_failed or r.rule == 0)


# --- clustering ---


def plain_clusters(rows, number, rounds):
    import fractions

    own = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(own, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:number]
    cents = [v for _, v in first]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(cents))
    for _ in range(rounds):
        groups = {}
        for _, v in own:
            groups.setdefault(near(v)[1], []).append(v)
        cents = [[math.floor(fractions.Fraction(sum(x), len(x))) for x in zip(*groups[k], strict=True)] if k in groups else c for k, c in enumerate(cents)]
    found = [(i, *near(v)[::-1]) for i, v in own]
    inertia = {}
    for _, k, d in found:
        inertia[k] = inertia.get(k, 0) + d
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted((str(i), k, d, inertia[k], sum(inertia.values()), names[k]) for i, k, d in found)


def vectors(spark, rows):
    return clashing(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int") if rows and len(rows[0]) == 3 else spark.createDataFrame(rows, "vec_id long, embedding array<double>"))


def clustered(spark, rows, number, rounds):
    got = centroids.clusters(vectors(spark, rows), number, rounds).collect()
    return sorted((str(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in got)


def test_clusters_of_random_vectors(spark):
    rng = random.Random(6)
    rows = [(i, [rng.gauss(i % 5, 0.3) for _ in range(64)]) for i in range(150)]
    assert clustered(spark, rows, 16, 3) == plain_clusters(rows, 16, 3)


def test_clusters_of_odd_vectors(spark):
    one = [0.01 * k for k in range(64)]
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, one[:63]), (4, one + [0.0]), (5, [nan] + one[1:]), (6, [inf] + one[1:]), (7, [None] + one[1:])]
    rows += [(8, one), (8, one), (8, [-x for x in one]), (None, one), (9, [100_000.0 * (-1) ** k for k in range(64)]), (10, [0.0] * 64), (11, [0.0] * 64)]
    rows += [(20 + k, one) for k in range(60)]
    for number in (1, 3, 100):
        assert clustered(spark, rows, number, 2) == plain_clusters(rows, number, 2)
    assert clustered(spark, [(1, None)], 3, 2) == [] and clustered(spark, [], 3, 2) == []
    assert clustered(spark, [(1, [float(1 << 18)] * 64), (2, one)], 2, 1) == plain_clusters([(2, one)], 2, 1)


def test_search_equals_all_distances_and_leaves_centroids_out():
    rng = np.random.default_rng(7)
    points, cents = rng.integers(-200, 200, (500, 64)).cumsum(1), rng.integers(-200, 200, (16, 64)).cumsum(1)
    cents[5] = cents[3]  # ties go to the smaller number
    cluster, distance = centroids.nearest(centroids.transformed(points), centroids.transformed(cents))
    apart = ((points[:, None] - cents[None]) ** 2).sum(2)
    assert (cluster == apart.argmin(1)).all() and (distance == apart.min(1)).all()


def test_transform_is_exact_and_coarse_first():
    matrix = centroids.hadamard()
    assert (matrix @ matrix.T == 64 * np.eye(64)).all() and ((matrix[:, 1:] != matrix[:, :-1]).sum(1) == np.arange(64)).all()
    x = np.random.default_rng(8).integers(-(1 << 24), 1 << 24, (50, 64))
    assert (centroids.transformed(x) == x @ matrix.T).all()
