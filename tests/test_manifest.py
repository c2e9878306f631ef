"""Manifest operators on small catalogs, against itertools."""

import itertools
import json

import pytest

from tessella.operators import manifest as M
from tessella.sources.catalog import read_catalog

CATALOG = {
    "Input_A": ["p1", "p2", "p3"],
    "Input_B": ["p1"],
    "NonSensitive_UI": ["n1", "n2"],
    "Empty_C": [],
    "Store_D": ["q{pattern2}", "q2"],
}


@pytest.fixture
def catalog(spark, tmp_path):
    path = tmp_path / "catalog.json"
    path.write_text(json.dumps(CATALOG, indent=1), encoding="utf-8")
    return read_catalog(spark, str(path))


def _names(df):
    return [r.filename for r in df.orderBy("ord").collect()]


def test_catalog_order(catalog):
    rows = [(r.category, r.idx, r.text) for r in catalog.orderBy("cat_pos", "idx").collect()]
    assert rows == [(c, i + 1, t) for c, texts in CATALOG.items() for i, t in enumerate(texts)]
    assert catalog.where("pattern_id = 'Store_D_2' and domain = 'Store' and sensitive").count() == 1


def test_broken_catalog_fails(spark, tmp_path):
    (tmp_path / "bad.json").write_text('{"a": ["x"')
    with pytest.raises(Exception):
        read_catalog(spark, str(tmp_path / "bad.json")).collect()


def _expected():
    ids = [(c, f"{c}_{i + 1}") for c, texts in CATALOG.items() if not c.startswith("NonSensitive_") for i in range(len(texts))]
    singles = [i for _, i in ids]
    pairs = [f"{a}_{b}" for c in CATALOG for a, b in itertools.combinations([i for k, i in ids if k == c], 2)]
    return singles + pairs + [f"Mixed_{i}" for i in singles]


def test_manifest_lists_tasks_in_order(catalog):
    assert _names(M.manifest(catalog, 1)) == _expected()
    counts = {r.task_type: r.n for r in M.manifest_counts(M.manifest(catalog, 1)).collect()}
    assert counts == {"Pure_nC1": 6, "Pure_nC2": 4, "Mixed": 6, None: 16}


@pytest.mark.parametrize("block", [1, 3, 7, 64])
def test_pairs_do_not_depend_on_the_block_size(spark, block):
    sizes = {"A_x": 20, "B_x": 1, "C_x": 7}
    rows = [(c, 0, i + 1, f"t{i}") for c, n in sizes.items() for i in range(n)]
    cat = M.index_patterns(spark.createDataFrame(rows, "category string, cat_pos int, idx int, text string"))
    got = [tuple(p["pattern_id"] for p in r.patterns) for r in M.pairs(cat, block).collect()]
    want = [(f"{c}_{i}", f"{c}_{j}") for c, n in sizes.items() for i, j in itertools.combinations(range(1, n + 1), 2)]
    assert sorted(got) == sorted(want)


def test_mixed_is_reproducible_and_varies_with_the_seed(catalog):
    def picks(seed):
        return [r.patterns[1]["text"] for r in M.mixed(catalog, seed).orderBy("ord").collect()]

    assert picks(3) == picks(3)
    assert len({tuple(picks(s)) for s in range(5)}) > 1
    assert set(picks(3)) <= set(CATALOG["NonSensitive_UI"])
    assert M.mixed(catalog.where("sensitive"), 3).count() == 0


def test_number_rows_is_contiguous(spark):
    rows = M.number_rows(spark.range(5000).selectExpr("cast(id as string) k"), "k").collect()
    assert sorted(r.n for r in rows) == list(range(5000))


def test_dedupe_keeps_first_place_and_last_value(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), ("a", 3, "z")], "filename string, ord int, v string")
    rows = [tuple(r) for r in M.dedupe_last(df, "filename", "ord").orderBy("ord").select("filename", "ord", "v").collect()]
    assert rows == [("a", 1, "z"), ("b", 2, "y")]


def test_prompts(catalog):
    kinds = itertools.product(("Pure_nC1", "Pure_nC2", "Mixed"), M.POLARITIES)
    slots = {"Pure_nC1": "{pattern}", "Pure_nC2": "{pattern1}&{pattern2}", "Mixed": "{sensitive_pattern}~{nonsensitive_pattern}"}
    templates = {(t, p): f"{p[:3]} {{{{}}}} {slots[t]}" for t, p in kinds}
    samples = M.expand_samples(M.manifest(catalog, 1), ["g1", "g2"])
    assert samples.count() == 16 * 4
    got = {r.base_filename: r.prompt for r in M.render_prompts(samples, templates).where("generator = 'g1'").collect()}
    assert got["Input_A_1_Input_A_3_negative"] == "neg {} p1&p3"
    assert got["Store_D_1_Store_D_2_positive"] == "pos {} q{pattern2}&q2"  # slot texts stay as they are
    assert got["Mixed_Input_B_1_positive"].startswith("pos {} p1~n")
    paths = M.artifact_paths(samples, "out").where("base_filename = 'Input_B_1_negative' and generator = 'g2'").first()
    assert paths.label_path == "out/outputs/g2_generated/Input_B_1_negative.json"


def test_catalog_files_are_strict(spark, tmp_path):
    from tessella.sources.catalog import read_catalog

    (tmp_path / "good.json").write_text('{"A_x": ["1"], "B_y": ["2"], "A_x": ["3", "4"]}')
    got = [(r.category, r.idx, r.text) for r in read_catalog(spark, str(tmp_path)).orderBy("cat_pos", "idx").collect()]
    assert got == [("A_x", 1, "3"), ("A_x", 2, "4"), ("B_y", 1, "2")]
    for i, text in enumerate(["{'A': ['1']}", '{"A": ["1"]} x', "[1]x"]):
        (tmp_path / f"bad{i}").mkdir()
        (tmp_path / f"bad{i}" / "c.json").write_text(text)
        with pytest.raises(Exception, match="strict JSON"):
            read_catalog(spark, str(tmp_path / f"bad{i}")).collect()


def test_paths_give_back_their_generator(spark):
    from tessella.sources.artifacts import parse_artifact_path

    samples = spark.createDataFrame([("gen_a", "x_positive")], "generator string, base_filename string")
    found = M.artifact_paths(samples).select(parse_artifact_path("label_path").alias("p")).first().p
    assert (found.generator, found.base_filename, found.kind) == ("gen_a", "x_positive", "label")


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_texts_are_joined_last(spark, catalog, tmp_path):
    M.numbered_positions(catalog).write.parquet(f"{tmp_path}/stored")
    stored = spark.read.parquet(f"{tmp_path}/stored")
    plan = _plan(M.dedupe_listed(M.listed(stored)))
    assert "SortAggregate" not in plan and "text:string" not in plan
    assert "SortAggregate" not in _plan(M.manifest(stored, 1)) and "text:string" not in _plan(M.catalog_counts(stored))


def test_manifest_has_the_tasks_of_its_parts(spark, catalog):
    """The manifest by names and numbers against the tasks with texts, put together and reduced to the last of each name."""
    rows = [("A_1", 0, 1, "a"), ("A_1", 0, 12, "b"), ("A", 1, 1, "c"), ("A", 1, 2, "d"), ("A", 1, 112, "e"), ("NonSensitive_x", 2, 1, "n"), ("NonSensitive_x", 2, 2, "m")]
    other = M.index_patterns(spark.createDataFrame(rows, "category string, cat_pos int, idx int, text string"))
    for cat in (M.numbered_positions(catalog), other, other.where("sensitive"), other.limit(0)):
        tasks = M.singles(cat).unionByName(M.pairs(cat)).unionByName(M.mixed(cat, 5))
        want = {r.filename: (r.task_type, r.patterns, r.ord) for r in M.dedupe_last(tasks, "filename", "ord").collect()}
        got = M.manifest(cat, 5).collect()
        assert {r.filename: (r.task_type, r.patterns, r.ord) for r in got} == want and len(got) == len(want)
        assert {r.task_type: r.n for r in M.catalog_counts(cat).collect()} == {r.task_type: r.n for r in M.manifest_counts(M.manifest(cat, 5)).collect()}


def test_order_numbers_are_in_order(spark):
    values = [(b, c, i, j) for b in (0, 2, 11) for c in (0, 5, 2**60 - 1) for i in (1, 2**31 - 1) for j in (0, 7)]
    df = spark.createDataFrame(values, "b int, c long, i int, j int").select("*", M.order_number(*[M.F.col(x) for x in "bcij"]).alias("o"))
    rows = df.select("*", M.F.array(*M.order_parts(*M.order_pieces(M.F.col("o")))).alias("back")).orderBy("o").collect()
    assert [(r.b, r.c, r.i, r.j) for r in rows] == sorted(values) == [tuple(r.back) for r in rows]
