"""Attempts, resume state, assembly, audit and artefact files on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from tessella.operators import audit, responses as R, resume as W
from tessella.sources import artifacts as A

GOOD = '{"reasoning": "r", "identifiers": ["a"]}'
ART = "generator string, base_filename string, kind string, content string"


def _art(spark, rows):
    return spark.createDataFrame([("g", *r) for r in rows], ART)


def test_first_success_takes_the_earliest(spark):
    rows = [
        (1, 1, "junk", None), (1, 2, GOOD, None), (1, 3, GOOD.replace("r", "q", 1), None),
        (2, 1, None, "quota"), (2, 4, GOOD, None),
        (3, 3, f"x {GOOD}", None),
    ]
    attempts = spark.createDataFrame(rows, "request_id int, attempt int, raw_response string, error_class string")
    got = {r.request_id: (r.status, r.attempt, r.method) for r in R.first_success(R.resolve_attempts(attempts), max_attempts=3).collect()}
    assert got == {1: ("ok", 2, "balanced"), 2: ("failed", None, None), 3: ("ok", 3, "slice")}


def test_outcomes_and_waits(spark):
    errors = ["blocked", "no_content", "quota", "timeout", "odd", None, None]
    rows = [(i, 1 + i % 3, " " if i == 5 else "t", e) for i, e in enumerate(errors)]
    attempts = spark.createDataFrame(rows, "request_id int, attempt int, raw_response string, error_class string")
    got = [r.outcome for r in R.classify_outcome(attempts).orderBy("request_id").collect()]
    assert got == ["blocked_no_candidates", "no_content", "quota", "timeout", "other", "empty_text", "ok"]
    waits = [(r.client_wait, r.caller_wait) for r in R.retry_wait(attempts).orderBy("request_id").collect()]
    assert waits == [(5, 1), (10, 2), (300, 0), (5, 1), (10, 2), (20, 0), (0, 0)]


def test_messages(spark):
    rows = [(1, 2, "user", "u"), (1, 1, "system", "b"), (1, 0, "system", "a"), (2, 0, "user", "x")]
    conv = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    systems, users = R.split_messages(conv)
    assert {(r.conv_id, r.system_prompt) for r in systems.collect()} == {(1, "a\nb"), (2, None)}
    assert {(r.conv_id, r.turn) for r in users.collect()} == {(1, 2), (2, 0)}
    assert [r.conv_id for r in R.empty_requests(spark.createDataFrame([(1,), (9,)], "conv_id int"), conv).collect()] == [9]


def test_stored_request_gives_its_symbols_back(spark):
    prompt = R.render_label_prompt(F.lit("let a = `x`"), F.lit('[{"symbolName":"a"}]'))
    row = spark.range(1).select(
        R.recover_symbols(prompt).alias("s"), R.recover_symbols(prompt, compat=True).alias("c"),
        R.recover_symbols(F.lit("AST Symbol Information (JSON):\n```\n[1]\n```")).alias("plain"),
        R.recover_symbols(F.lit("nothing")).alias("none"),
    ).first()
    assert tuple(row) == ('[{"symbolName":"a"}]', None, "[1]", None)


def test_input_frame(spark):
    row = spark.createDataFrame([("code", '[{"a":1}]'), ("c", "raw")], "c string, s string").select(R.render_input("c", "s").alias("i")).collect()
    assert row[0].i == (
        "**Swift Source Code:**\n```swift\ncode\n```\n\n**AST Symbol Information (JSON):**\n```\n"
        '[\n  {\n    "a": 1\n  }\n]\n```'
    )
    assert row[1].i.endswith("```\nraw\n```")


STATES = {
    # name: (code, label, symbols, state)
    "done": ("c", GOOD, "[]", "complete"),
    "keyless": ("c", "7", "[]", "complete"),
    "sentinel": ("c", W.FAILURE_SENTINEL, "[]", "complete"),
    "bad_label": ("c", "{", "[]", "reuse_code"),
    "blank_label": ("c", " ", "[]", "reuse_code"),
    "no_label": ("c", None, "[]", "reuse_code"),
    "no_symbols": ("c", GOOD, None, "reuse_code"),
    "blank_code": (" \n", GOOD, "[]", "generate"),
    "no_code": (None, GOOD, "[]", "generate"),
    "nothing": (None, None, None, "generate"),
}


@pytest.fixture
def stored(spark):
    rows = [(n, k, v) for n, (code, label, _, _) in STATES.items() for k, v in (("code", code), ("label", label)) if v is not None]
    symbols = [("g", n, s) for n, (_, _, s, _) in STATES.items() if s is not None]
    return (
        spark.createDataFrame([("g", n) for n in STATES], "generator string, base_filename string"),
        _art(spark, rows),
        spark.createDataFrame(symbols, "generator string, base_filename string, symbols_json string"),
    )


def test_work_state(stored):
    samples, artifacts, symbols = stored
    got = {r.base_filename: r.state for r in W.work_state(samples, artifacts, symbols).collect()}
    assert got == {n: s[3] for n, s in STATES.items()}


def test_complete_and_pending_cover_all_samples(stored):
    samples, artifacts, symbols = stored
    done = W.completed(artifacts, symbols)
    left = W.pending(samples, done)
    names = [r.base_filename for r in left.collect()] + [r.base_filename for r in done.collect()]
    assert sorted(names) == sorted(STATES)
    assert "LeftAnti" in left._jdf.queryExecution().toString()


@pytest.mark.parametrize(
    "label, want",
    [(GOOD, True), (W.FAILURE_SENTINEL, True), ('{"a": 12}', False), ('{"a": 123}', False), ('{"a": 1234}', True),
     (" " * 20, False), ('{"a": "é"}', True), ("{" * 20, False), (None, False)],
)
def test_is_labelled(column, label, want):
    assert column(W.is_labelled, [label]) == [want]


def test_assembly_rejects_in_order(spark):
    cases = {
        # name: (label, code, prompt, computed symbols, reject)
        "ok": (GOOD, "c", "p", "[]", None),
        "stored": (GOOD, "c", R.SYMBOLS_HEADING + "\n```json\n[1]\n```", None, None),
        "sentinel": (W.FAILURE_SENTINEL, "c", "p", "[]", None),
        "small": ("{}", None, None, None, "label_too_small"),
        "blank": (" " * 11, None, None, None, "label_blank"),
        "broken": ("{" * 11, None, None, None, "label_not_json"),
        "no_code": (GOOD, None, "p", "[]", "artifact_missing"),
        "no_prompt": (GOOD, "c", None, "[]", "artifact_missing"),
        "blank_code": (GOOD, " ", "p", "[]", "code_blank"),
        "no_symbols": (GOOD, "c", "p", None, "no_symbols"),
        "bad_symbols": (GOOD, "c", "p", "[", "bad_json"),
        "odd_space": ("\xa0" + GOOD, "c", "p", "[]", "bad_json"),
    }
    rows = [("pr", n, k, v) for n, c in cases.items() for k, v in zip(("label", "code", "prompt"), c) if v is not None]
    rows.append(("pr", "unlabelled", "code", "c"))
    artifacts = spark.createDataFrame(rows, "project string, base_filename string, kind string, content string")
    symbols = spark.createDataFrame([("pr", n, c[3]) for n, c in cases.items() if c[3]], "project string, base_filename string, symbols_json string")
    entries, rejects = W.assemble(artifacts, symbols)
    assert {r.base_filename: r.reject for r in rejects.collect()} == {n: c[4] for n, c in cases.items() if c[4]}
    rows = {r.base_filename: r for r in entries.collect()}
    assert set(rows) == {"ok", "stored", "sentinel"}
    assert rows["ok"].output == GOOD and rows["ok"].instruction == R.INSTRUCTION
    assert rows["stored"].input.endswith("```\n[\n  1\n]\n```")
    counts = W.assembly_counts(W.judge(artifacts, symbols), spark.createDataFrame([("pr",), ("empty",)], "project string"))
    assert {tuple(r) for r in counts.collect()} == {("pr", 3, 9), ("empty", 0, 0), (None, 3, 9)}


def test_counts_shuffle_no_text(spark):
    artifacts = spark.createDataFrame([("p", "n", "label", GOOD)], "project string, base_filename string, kind string, content string")
    symbols = spark.createDataFrame([("p", "n", "[]")], "project string, base_filename string, symbols_json string")
    plan = W.assembly_counts(W.judge(artifacts, symbols), artifacts.select("project"))._jdf.queryExecution()
    aggregates = [line for line in plan.optimizedPlan().toString().splitlines() if "Aggregate [project" in line]
    assert aggregates and not any("max(label#" in line or "max(code#" in line for line in aggregates)


def test_mark_failed(spark):
    df = spark.createDataFrame([(1, "ok", GOOD), (2, "failed", None)], "request_id int, status string, label string")
    assert {r.request_id: r.label for r in W.mark_failed(df).collect()} == {1: GOOD, 2: W.FAILURE_SENTINEL}


AUDITED = {
    '{"reasoning": "r", "identifiers": []}': True,
    '{"identifiers": []}': True,
    GOOD: False,
    '{"reasoning": "r"}': False,
    '{"identifiers": ""}': False,
    '{"identifiers": null}': False,
    '{"identifiers": {}}': False,
    '["identifiers"]': False,
    "broken": False,
}


def test_audit_and_prune(spark):
    rows = [(f"s{i}_positive", "label", t) for i, t in enumerate(AUDITED)]
    rows += [("n_negative", "label", '{"identifiers": []}'), ("s0_positive", "code", "c")]
    artifacts = _art(spark, rows)
    got = {r.base_filename: r.flagged for r in audit.audit_positive(artifacts).collect()}
    assert got == {f"s{i}_positive": want for i, want in enumerate(AUDITED.values())}
    once = audit.prune(artifacts, audit.flagged(artifacts))
    assert once.count() == len(rows) - 2 and once.where("kind = 'code'").count() == 1
    assert audit.prune(once, audit.flagged(once)).count() == once.count()
    assert {tuple(r) for r in audit.audit_summary(artifacts).collect()} == {("g", 9, 2), (None, 9, 2)}


def test_negative_removal(spark):
    artifacts = _art(spark, [("a_negative", "code", "x"), ("a_negative", "label", "x"), ("a_positive", "code", "x"), ("negative", "code", "x")])
    chosen = audit.select_negative(artifacts)
    assert audit.remove(artifacts, chosen).count() == 2
    assert audit.remove(artifacts, chosen, dry_run=False).count() == 2
    assert audit.select_negative(artifacts, "other").count() == 0
    ghost = chosen.withColumn("base_filename", F.lit("gone_negative"))
    assert tuple(audit.removal_counts(artifacts, chosen.unionByName(ghost)).first()) == (2, 2)


def test_artifact_files(spark, tmp_path):
    for name, text in {
        "gen_a/x_positive.swift": "let é = 1\n", "gen_a/x_positive.json": "{}", "gen_b/deep/y_negative.txt": "p",
        "gen_b/z.v2.swift": "", "gen_b/w.v2.swift": "w", "gen_b/skip.md": "no",
    }.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(text, encoding="utf-8")
    rows = {(r.folder, r.base_filename, r.ext): r for r in A.read_artifacts(spark, str(tmp_path)).collect()}
    one = rows["gen_a", "x_positive", ".swift"]
    assert (one.kind, one.polarity, one.content, one.n_bytes) == ("code", "positive", "let é = 1\n", 11)
    assert rows["deep", "y_negative", ".txt"].polarity == "negative"
    assert (rows["gen_b", "z.v2", ".swift"].content, rows["gen_b", "z.v2", ".swift"].n_bytes) == ("", 0)
    assert rows["gen_b", "w.v2", ".swift"].polarity is None and rows["gen_b", "skip", ".md"].kind is None
    assert A.read_artifacts(spark, str(tmp_path), "*_negative.*").count() == 1
    assert A.read_artifacts(spark, str(tmp_path / "gen_b"), recursive=False).count() == 3


def test_snapshot_replaces_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "snap")
    A.write_snapshot(_art(spark, [("a", "code", "1"), ("a", "label", "1")]), path)
    A.write_snapshot(_art(spark, [("b", "label", "2")]), path)
    rows = spark.read.parquet(path).select("base_filename", "kind", "content").collect()
    assert sorted(map(tuple, rows)) == [("a", "code", "1"), ("b", "label", "2")]


def test_project_order_and_discovery(spark):
    rows = [("b", "x", "code"), ("a", "x", "label"), ("z", "x", "code"), ("z", "y", "code"), ("c", "x", "prompt")]
    artifacts = spark.createDataFrame(rows, "project string, base_filename string, kind string")
    names = [r.project for r in A.order_projects(A.projects(artifacts), ["z", "absent", "c"]).collect()]
    assert names == ["z", "c", "a", "b"]
    assert [r.project for r in A.order_projects(A.projects(artifacts)).collect()] == ["a", "b", "c", "z"]
    _, counts = A.discover_sources(artifacts)
    assert {r.project: r.n_code for r in counts.collect()} == {"a": 0, "b": 1, "c": 0, "z": 2}


def test_updates_of_one_key(spark):
    base = _art(spark, [("a", "code", "old"), ("b", "code", "kept")])
    twice = _art(spark, [("a", "code", "1"), ("a", "code", "2")])
    with pytest.raises(Exception, match="several updates"):
        A.upsert(base, twice).collect()
    ordered = twice.withColumn("at", F.col("content").cast("int"))
    assert sorted(r.content for r in A.upsert(base, ordered, order="at").collect()) == ["2", "kept"]
    assert sorted(r.content for r in A.upsert(base, twice.where("content = '1'")).collect()) == ["1", "kept"]


def test_all_attempts_count_unless_limited(spark):
    attempts = spark.createDataFrame([(1, 4, GOOD, None), (1, 4, GOOD, None), (1, 1, "x", None)], "request_id int, attempt int, raw_response string, error_class string")
    resolved = R.resolve_attempts(attempts)
    assert [(r.status, r.attempt) for r in R.first_success(resolved).collect()] == [("ok", 4)]
    assert [r.status for r in R.first_success(resolved, max_attempts=3).collect()] == ["failed"]
    assert "SortAggregate" not in R.first_success(resolved)._jdf.queryExecution().executedPlan().toString()


def test_known_projects_count_zero(spark):
    artifacts = spark.createDataFrame([("a", "x", "code")], "project string, base_filename string, kind string")
    _, counts = A.discover_sources(artifacts, spark.createDataFrame([("a",), ("empty",)], "project string"))
    assert {r.project: r.n_code for r in counts.collect()} == {"a": 1, "empty": 0}


def test_upsert_looks_up_touched_parts_only(spark, tmp_path):
    import pyarrow.parquet as pq

    from tessella.sources import artifacts as A

    rows = [(g, b, k, f"{g}{b}{k}") for g in ("a", "b", None) for b in ("x", "y", None) for k in ("code", "label")]
    existing = spark.createDataFrame(rows, "generator string, base_filename string, kind string, content string")
    new = [("a", "x", "label", "new"), ("a", "z", "label", "added"), ("c", "x", "code", "first")]
    updates = spark.createDataFrame(new, existing.schema)
    out = A.upsert(existing, updates)
    kept = [r for r in rows if r[:3] != ("a", "x", "label")]
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, kept + new))
    joins = [line for line in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "LeftSemi" in line]
    assert joins and all("broadcast" in line for line in joins)
    A.write_snapshot(out, f"{tmp_path}/s")
    files = [str(p) for p in tmp_path.rglob("*.parquet")]
    assert files and {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files} == {"ZSTD"}
