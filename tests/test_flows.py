"""Whole runs on a few sources, and what is beyond the JSON parser."""

import json

from pyspark.sql import functions as F

from tessella.functions import labels
from tessella.operators import flows, responses
from tessella.sources import entries
from tessella.streaming import ingest

GOOD = '{"reasoning":"r","identifiers":["token"]}'
SOURCES = [("p", "a", 1, "class A { func f() { g() } }"), ("p", "b", 2, "let x = 1"), ("q", "c", 3, " \n"), ("q", "d", 4, "struct D {}")]


def run(spark, attempts, known=None):
    sources = spark.createDataFrame(SOURCES, "project string, base_filename string, request_id long, code string")
    tries = spark.createDataFrame(attempts, ingest.ATTEMPTS)
    if known is not None:
        known = spark.createDataFrame(known, "project string, base_filename string, content string")
    made, good, bad = flows.run(sources, tries, known)
    return made.collect(), {r.base_filename: r for r in good.collect()}, {r.base_filename: r.reject for r in bad.collect()}


def test_from_sources_to_entries(spark):
    tries = [(1, 1, "no", None), (1, 2, f"```json\n{GOOD}\n```", None), (2, 1, None, "quota"), (3, 1, GOOD, None), (4, 4, GOOD, None)]
    made, good, bad = run(spark, tries)
    assert set(good) == {"a", "b", "d"} and bad == {}
    assert good["a"].output == GOOD and good["b"].output == good["d"].output == '{"error": "generation_failed"}'
    block = good["a"].input.split("**AST Symbol Information (JSON):**\n```\n")[1].removesuffix("\n```")
    assert [s["symbolName"] for s in json.loads(block)] == ["A", "f(())"] and block.startswith('[\n  {\n    "symbolName"')
    assert json.loads(block)[1]["calls_out"] == ["g"]
    kinds = sorted((r.base_filename, r.kind) for r in made)
    assert kinds == [(n, k) for n in "ab" for k in ("code", "label", "prompt")] + [("c", "code")] + [("d", k) for k in ("code", "label", "prompt")]


def test_labelled_sources_are_not_asked_again(spark):
    kept = '{"reasoning":"kept","identifiers":[]}'
    made, good, bad = run(spark, [(1, 1, GOOD, None), (2, 1, GOOD, None)], [("p", "a", kept), ("q", "c", "not json at all")])
    assert good["a"].output == kept and good["b"].output == GOOD
    assert bad == {"c": "label_not_json"}


def test_what_is_too_deep_is_named_so(spark):
    deep, wide = "[" * 1001 + "]" * 1001, "[" + "[1]," * 2000 + "[2]]"
    texts = {"ok": "[" * 998 + "]" * 998, "deep": deep, "wide": wide, "number": '{"output":%s}' % ("9" * 1200), "broken": "{" * 3, "text": json.dumps("[" * 5000), "open": '{"a":"' + "[" * 3000}
    df = spark.createDataFrame(list(texts.items()), "k string, t string")
    got = {r.k: (r.j, r.l) for r in df.select("k", labels.is_strict_json("t").alias("j"), labels.is_too_large("t").alias("l")).collect()}
    assert {k: v[0] for k, v in got.items()} == {"ok": True, "deep": False, "wide": True, "number": True, "broken": False, "text": True, "open": False}
    assert got["deep"][1] and not got["broken"][1] and not got["wide"][1]
    lines = entries.parse_lines(df.select("k", F.col("t").alias("line")))
    assert {r.k: r.reject for r in lines.collect()} == {"ok": "not_object", "deep": "too_large", "wide": "not_object", "number": "output_not_text", "broken": "not_json", "text": "not_object", "open": got["open"][1] and "too_large" or "not_json"}
    tried = ingest.parse_attempts(df.select(F.col("k").alias("file"), F.col("t").alias("line")))
    assert {r.file: r.reject for r in tried.collect()}["deep"] == "too_large"


def test_queries_without_the_corpus_package(monkeypatch):
    import sys

    import __spark_entry__ as entry

    whole = set(entry.queries())
    monkeypatch.setitem(sys.modules, "tessella.llm", None)
    monkeypatch.delitem(sys.modules, "tessella.llm.queries", raising=False)
    rest = set(entry.queries())
    assert rest <= whole and "dataset_comparison" in rest and not any(n.startswith("op") or n == "pipeline" for n in rest)
    assert set(entry.oracle_sql()) <= rest


def test_symbols_of_a_request_end_at_the_first_fence(spark):
    """They are found without asking at each of their characters whether blanks and a fence follow."""
    import random
    import re

    rng, head = random.Random(3), "AST Symbol Information (JSON):"
    parts = [head, f"{head}**\n```json\n", "**", "```", "``", "`", "json", " ", "\n", "[1]", "x", "é"]
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 12))) for _ in range(3000)] + [head + "**\n```json\n" + "a`b``c" * 200000 + " \n```"]

    def plain(text):
        found = re.search(re.escape(head) + r"\*{0,2}\s*```(?:json)?\s*(.*?)\s*```", text, re.S)
        return (found[1].strip() or None) if found else None

    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", responses.recover_symbols("t").alias("got"))
    assert all(r.got == plain(r.t) for r in rows.collect())
    assert "(.*?)" not in rows._jdf.queryExecution().optimizedPlan().toString()
