"""The corpus pipeline, its queries and their SQL."""

import sys
from pathlib import Path

import corpus_pipeline
import oracle_check
import pytest
from helpers import clashing, documents, fits, prose, weighted_classes
from pyspark.sql import functions as F

from tessella.llm import neardup, queries, stages
from tessella.llm.tables import table

SF = "/root/testdata/sf0.001"
sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="module")
def database():
    return oracle_check.connect(SF)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_matches_sql(spark, database, name):
    assert oracle_check.compare(spark, database, name, SF) is None


def test_registered_once_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.REGISTRY) == list(range(1, 14))


def test_stages_keep_columns_and_take_effect(spark):
    docs = table(spark, SF, "documents")
    bench = table(spark, SF, "benchmark").first().text
    twin = prose(1, 3)[0]
    more = [(10**6, "idiot stupid moron scum " * 5), (10**6 + 1, twin), (10**6 + 2, twin + " more"), (10**6 + 3, f"{prose(1, 4)[0]} {bench}"), (10**6 + 4, "quiet words token=abcdefgh here"), (10**6 + 5, None), (None, "")]
    docs = clashing(docs.unionByName(documents(spark, more)))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, SF)
        assert docs.columns == before.columns
        assert docs.schema["text"].dataType == before.schema["text"].dataType
        docs = docs.checkpoint() if spark.sparkContext.getCheckpointDir() else docs.cache()
    left = {r.doc_id: r for r in docs.filter("doc_id >= 1000000").collect()}
    assert set(left) in ({10**6 + 1, 10**6 + 4, 10**6 + 5}, {10**6 + 1, 10**6 + 4})  # the null may give way to the empty text
    assert left[10**6 + 4].text == "quiet words [REDACTED] here" and left[10**6 + 4].n_chars == 27
    packed = stages.packed_sequences(spark, docs, SF).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in docs.collect()}


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES])
def test_stages_of_empty_tables(spark, stage):
    assert stage(spark, documents(spark, []), SF).count() == 0


def test_one_of_each_class_stays(spark):
    text = prose(2, 6)
    docs = documents(spark, [(1, text[0]), (1, text[0]), (2, text[0]), (3, text[1]), (3, text[1]), (None, "z"), (None, "z"), (4, "z")])
    got = sorted((r.doc_id for r in stages.near_duplicates(spark, docs, SF).collect()), key=str)
    assert len(got) == 3 and got[:2] == [1, 3]


def test_run_is_the_stages_by_plain_code(spark):
    """Rows of run() on the smallest tables against the single operators applied one by one."""
    docs = table(spark, SF, "documents")
    clean = stages.toxic_documents(spark, docs, SF)
    kept = sorted((r.doc_id, r.text) for r in clean.collect())
    of = weighted_classes(kept)
    kept = [(i, t) for i, t in kept if of[i] == i]
    import re

    bench = [re.findall(r"[^\W_]+", r.text.lower()) for r in table(spark, SF, "benchmark").collect()]
    grams = {tuple(w[k : k + 10]) for w in bench for k in range(len(w) - 9)}

    def leaked(text):
        w = re.findall(r"[^\W_]+", text.lower())
        return any(tuple(w[k : k + 10]) in grams for k in range(len(w) - 9))

    want = {i for i, t in kept if not leaked(t)}
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in got} == want
    assert fits([(r.sequence_id, r.offset, r.length) for r in got], 1024)
    assert neardup.THRESHOLD == 0.8 and F is not None
