"""Reading and writing datasets, and statistics on hand-made entries."""

import json

import pytest
from pyspark.sql import functions as F

from tessella.operators import analytics
from tessella.session import scratch_path
from tessella.sources import entries as ents

ENTRIES = [
    {"instruction": "i", "input": "ü\n", "output": '{"reasoning": "abc", "identifiers": ["a", 1, "b", "a"]}'},
    {"instruction": "i", "input": "y", "output": '{"reasoning": null, "identifiers": []}'},
    {"instruction": "i", "input": "z", "output": ' {"reasoning": "' + "x" * 101 + '", "identifiers": ["b"]} '},
    {"instruction": "i", "input": "q", "output": '{"reasoning": 3, "identifiers": "a"}'},
    {"instruction": "i", "input": "q", "output": '{"reasoning": "no list"}'},
    {"instruction": "i", "input": "q", "output": "  "},
    {"instruction": "i", "input": "q"},
]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("datasets")
    good = [json.dumps(e, ensure_ascii=False) for e in ENTRIES]
    bad = ["", "  ", "{broken", "[1]", '{"output": 3}', '{"output": null}', good[0] + " tail"]
    (path / "gen_a.jsonl").write_text("\n".join(good[:3] + bad + good[3:]) + "\n", encoding="utf-8")
    (path / "gen_b.jsonl").write_text("\n".join(good[:2]), encoding="utf-8")
    (path / "empty.jsonl").write_text("")
    return str(path)


def test_read_counts_and_order(spark, folder):
    entries, rejects = ents.read_entries(spark, folder)
    numbered = ents.number_entries(entries)
    got = [(r.entry_id, r.input, r.output) for r in numbered.where("dataset = 'gen_a'").orderBy("entry_id").collect()]
    assert got == [(i, e["input"], e.get("output")) for i, e in enumerate(ENTRIES)]
    reasons = [r.reject for r in rejects.orderBy("file", "entry_id").collect()]
    assert reasons == ["not_json", "not_object", "output_not_text", "output_not_text", "not_json"]
    assert ents.reject_sample(rejects, 3).count() == 3


def test_number_entries_over_many_splits(spark, tmp_path):
    lines = [json.dumps({"instruction": "i", "input": str(i), "output": "x" * (i % 50)}) for i in range(5000)]
    (tmp_path / "big.jsonl").write_text("\n".join(lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 20000)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        entries, _ = ents.read_entries(spark, str(tmp_path))
        assert entries.select("entry_id.block").distinct().count() > 5
        rows = ents.number_entries(entries).select("entry_id", "input").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted((r.entry_id, int(r.input)) for r in rows) == [(i, i) for i in range(5000)]


def test_select_datasets(spark, folder):
    entries, _ = ents.read_entries(spark, folder)

    def names(**kw):
        return {r.dataset for r in ents.select_datasets(entries, **kw).select("dataset").distinct().collect()}

    assert names(names=["gen_b", "missing"]) == {"gen_b"}
    assert names(known=["gen_a", "gen_b", "empty"]) == {"gen_a", "gen_b"}
    assert names(default="gen_a") == {"gen_a"}


@pytest.fixture(scope="module")
def parsed(spark, folder):
    entries, _ = ents.read_entries(spark, folder)
    return analytics.parse_outputs(ents.number_entries(entries).where("dataset = 'gen_a'")).cache()


@pytest.mark.parametrize("one_pass", [True, False])
def test_statistics(parsed, one_pass):
    two = (analytics.profile(parsed), analytics.identifier_counts(parsed))
    prof, counts = analytics.summarize(parsed) if one_pass else two
    assert tuple(analytics.basic_stats(prof).first()) == ("gen_a", 7, 4, 3, pytest.approx(400 / 7))
    assert tuple(analytics.class_split(prof).first()) == ("gen_a", 1, 2, 25.0, 50.0)
    assert {(r.n_items, r.n, r.pct) for r in analytics.count_distribution(prof).collect()} == {(4, 1, 50.0), (1, 1, 50.0)}
    assert tuple(analytics.count_stats(prof).first()) == ("gen_a", 1, 4, 2.5, 2.5)
    assert tuple(analytics.reasoning_stats(prof).first()) == ("gen_a", 3, 101, 52.0, 52.0)
    assert {(r.label, r.n) for r in analytics.length_histogram(prof).collect()} == {("Very Short", 1), ("Short", 1)}
    top = analytics.top_identifiers(counts).orderBy("rank").collect()
    assert [(r.identifier, r.n, r.pct) for r in top] == [("a", 2, 50.0), ("b", 2, 50.0)]  # tie: first seen first
    assert tuple(analytics.diversity(counts).first()) == ("gen_a", 2, 4, 2.0)
    assert tuple(analytics.compare(prof, counts).first()) == ("gen_a", 7, 4, 1, 2, 2)
    members = {(r.category, r.entry_id) for r in analytics.category_members(parsed).collect()}
    assert members == {("vulnerable", 0), ("secure", 1), ("vulnerable", 2), ("invalid", 3)}


def test_top_k_is_limited_before_the_shuffle(parsed):
    plan = analytics.top_identifiers(analytics.identifier_counts(parsed), 3)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_outputs_are_parsed_once(spark):
    df = spark.createDataFrame([("d", 0, "x")], "dataset string, entry_id long, output string")
    counts = analytics.identifier_counts(analytics.parse_outputs(df))
    plan = counts._jdf.queryExecution().executedPlan().toString()
    once = analytics.parse_outputs(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == once.count("from_json") > 0


def test_numbering_after_parsing(spark, folder):
    entries, _ = ents.read_entries(spark, folder)
    numbered = ents.number_entries(analytics.parse_outputs(entries), by="dataset")
    got = {r.entry_id: r.category for r in numbered.where("dataset = 'gen_a'").collect()}
    assert got == {0: "vulnerable", 1: "secure", 2: "vulnerable", 3: "invalid", 4: None, 5: None, 6: None}


def test_report_of_a_dataset_without_valid_outputs(spark):
    rows = [("d" * 30, 0, "x"), ("d" * 30, 1, None)]
    parsed = analytics.parse_outputs(spark.createDataFrame(rows, "dataset string, entry_id long, output string"))
    row = analytics.report(*analytics.summarize(parsed)).first()
    assert (row.total, row.valid, row.secure_pct, row.top_identifiers) == (2, 0, None, None)
    assert tuple(analytics.compare_pct(analytics.profile(parsed)).first()) == ("d" * 30, 0.0, 0.0, 0.0)


def test_buckets_add_up(spark):
    rows = [("d", i, json.dumps({"reasoning": "x" * n, "identifiers": []})) for i, n in enumerate([0, 100, 101, 200, 201, 400, 401, 600, 601, 5000])]
    parsed = analytics.parse_outputs(spark.createDataFrame(rows, "dataset string, entry_id long, output string"))
    hist = analytics.length_histogram(analytics.profile(parsed)).orderBy("bucket").collect()
    assert [r.n for r in hist] == [2, 2, 2, 2, 2]
    assert sum(r.pct for r in hist) == pytest.approx(100)


def test_lengths_count_characters(spark):
    df = spark.createDataFrame([("d", 0, '{"reasoning": "a😀é", "identifiers": []}')], "dataset string, entry_id long, output string")
    assert analytics.parse_outputs(df).first().reasoning_len == 3


def test_write_then_read_is_identity(spark, folder):
    entries, _ = ents.read_entries(spark, folder)
    path = scratch_path(spark, "round")
    ents.write_entries(entries.where("dataset = 'gen_a'"), path)
    again, rejects = ents.read_entries(spark, path + "/*")
    assert rejects.count() == 0
    key = lambda e: (e["input"], e.get("output") or "")
    got = sorted((key(r.asDict()) for r in again.collect()))
    assert got == sorted(map(key, ENTRIES))


def test_empty_projects_write_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], "project string, instruction string, input string, output string")
    ents.write_project_entries(empty, str(tmp_path / "by"), str(tmp_path / "all"))
    assert not any(f.read_text() for f in tmp_path.glob("**/*.json"))


def test_combine_is_a_bag_union(spark):
    a = spark.createDataFrame([("a", 1), ("a", 1)], "dataset string, entry_id int")
    b = spark.createDataFrame([("b", 1)], "dataset string, entry_id int")
    both = ents.combine({"a": a, "b": b})
    assert both.count() == 3 and {r.part for r in both.collect()} == {"a", "b"}


def test_statistics_do_not_depend_on_partitioning(spark):
    rows = [("d", i, json.dumps({"reasoning": "r" * (i % 7), "identifiers": [f"x{i % 5}", f"y{i % 3}"]})) for i in range(300)]
    df = spark.createDataFrame(rows, "dataset string, entry_id long, output string")

    def top(n):
        counts = analytics.identifier_counts(analytics.parse_outputs(df.repartition(n)))
        return [tuple(r) for r in analytics.top_identifiers(counts, 4).orderBy("rank").collect()]

    assert top(1) == top(13)


def test_written_datasets_keep_their_names(spark, tmp_path):
    rows = [("gen a+b/c%20", "i", "in", '{"reasoning":"r","identifiers":["x"]}'), ("gen_b", "i", "in", "x")]
    path = str(tmp_path / "a b+c")
    ents.write_entries(spark.createDataFrame(rows, "dataset string, instruction string, input string, output string"), path)
    good, _ = ents.read_entries(spark, path)
    assert sorted(r.dataset for r in good.collect()) == ["gen a+b/c%20", "gen_b"]


@pytest.mark.parametrize("k", [3, 1000, 1001])
def test_top_k_cuts_each_bucket_first(spark, k):
    rows = [("d", i, f"w{i % 700}", 1) for i in range(2000)]
    counts = (
        spark.createDataFrame(rows, "dataset string, entry_id long, identifier string, pos int")
        .groupBy("dataset", "identifier").agg(F.count("*").alias("n"), F.min(F.struct("entry_id", "pos")).alias("first_seen"))
    )
    top = analytics.top_identifiers(counts, k)
    assert top.count() == min(k, 700)
    assert top._jdf.queryExecution().executedPlan().toString().count("Window [row_number") >= 2


def test_counts_use_hash_aggregates(spark):
    df = spark.createDataFrame([("d", 0, "x")], "dataset string, entry_id long, output string")
    parsed = analytics.parse_outputs(df)
    for table in (analytics.identifier_counts(parsed), analytics.top_identifiers(analytics.identifier_counts(parsed)), *analytics.summarize(parsed)):
        assert "SortAggregate" not in table._jdf.queryExecution().executedPlan().toString()
