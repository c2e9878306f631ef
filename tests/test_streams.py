"""Arriving responses, winners kept in state, and files listed by tasks."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from tessella.operators import responses as R
from tessella.sources import artifacts, listing
from tessella.streaming import ingest

GOOD = '{"reasoning":"%s","identifiers":[]}'


def arrive(spark, folder, name, lines):
    """One more file of lines."""
    os.makedirs(f"{folder}/in", exist_ok=True)
    with open(f"{folder}/in/{name}.jsonl", "w") as f:
        f.write("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")
    ingest.ingest_responses(spark, f"{folder}/in", f"{folder}/out", f"{folder}/progress")


def winners(spark, folder, **more):
    ingest.update_winners(spark, f"{folder}/out", f"{folder}/won", f"{folder}/progress", **more)
    rows = ingest.read_winners(spark, f"{folder}/won", f"{folder}/out").collect()
    assert len({r.request_id for r in rows}) == len(rows)
    return {r.request_id: (r.status, r.attempt, r.label, r.method) for r in rows}


def changes(spark, folder):
    return spark.read.schema(ingest.WINNERS).parquet(f"{folder}/won").count()


def attempt(request, number, text=None, error=None):
    return {"request_id": request, "attempt": number, "raw_response": text, "error_class": error}


def test_late_and_repeated_attempts(spark, tmp_path):
    lot = [attempt(1, 2, GOOD % "b"), attempt(2, 1, "no label"), attempt(3, 1, GOOD % "z"), attempt(3, 1, GOOD % "z")]
    arrive(spark, tmp_path, "a", lot)
    first = winners(spark, tmp_path)
    assert first == {1: ("ok", 2, GOOD % "b", "balanced"), 2: ("failed", None, None, None), 3: ("ok", 1, GOOD % "z", "balanced")} or first[1][:3] == ("ok", 2, GOOD % "b")
    assert changes(spark, tmp_path) == 3
    assert winners(spark, tmp_path) == first and changes(spark, tmp_path) == 3  # nothing new
    arrive(spark, tmp_path, "b", lot)  # the same lines in another file
    assert winners(spark, tmp_path) == first and changes(spark, tmp_path) == 3
    arrive(spark, tmp_path, "c", [attempt(1, 1, GOOD % "a"), attempt(2, 5, GOOD % "late"), attempt(1, 3, GOOD % "c")])
    now = winners(spark, tmp_path)
    assert (now[1][1], now[1][2], now[2][1], now[2][2], now[3]) == (1, GOOD % "a", 5, GOOD % "late", first[3])
    assert changes(spark, tmp_path) == 5


def test_attempts_beyond_the_allowed_ones(spark, tmp_path):
    arrive(spark, tmp_path, "a", [attempt(1, 4, GOOD % "x"), attempt(2, 3, GOOD % "y")])
    got = winners(spark, tmp_path, max_attempts=3)
    assert got[1][0] == "failed" and got[2][:2] == ("ok", 3)


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_lots_gives_the_batch_result(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = [attempt(q, n, rng.choice([None, "", "junk", GOOD % "u", GOOD % "v", "x " + GOOD % "w"])) for q in range(40) for n in range(1, 5)]
    rows += rng.choices(rows, k=30)
    rng.shuffle(rows)
    for k in range(3):
        arrive(spark, tmp_path, str(k), rows[k::3])
        got = winners(spark, tmp_path)
    batch = R.first_success(ingest.read_resolved(spark, f"{tmp_path}/out")).collect()
    assert got == {r.request_id: (r.status, r.attempt, r.label, r.method) for r in batch}


def test_lines_are_read_once_and_rejects_are_kept(spark, tmp_path):
    arrive(spark, tmp_path, "a", [attempt(1, 1, GOOD % "x"), "{", "[1]", '{"request_id":"1","attempt":1}', "", attempt(2, 1, error="quota")])
    assert sorted(r.reject for r in ingest.read_rejected(spark, f"{tmp_path}/out").collect()) == ["bad_field", "not_json", "not_object"]
    rows = ingest.read_resolved(spark, f"{tmp_path}/out").collect()
    assert sorted((r.request_id, r.attempt, r.error_class, r.label) for r in rows) == [(1, 1, None, GOOD % "x"), (2, 1, "quota", None)]
    assert os.listdir(f"{tmp_path}/progress") == ["lines"]


def test_first_success_reads_its_input_once(spark, tmp_path):
    spark.createDataFrame([(1, 1, GOOD % "a", None), (1, 2, GOOD % "b", None), (2, 1, "x", None)], ingest.ATTEMPTS).write.parquet(f"{tmp_path}/raw")
    got = R.first_success(R.resolve_attempts(spark.read.parquet(f"{tmp_path}/raw")))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "raw_response" not in plan and "from_json" not in plan
    assert "SortAggregate" not in plan and "SortMergeJoin" not in plan and "Window" not in plan
    assert {(r.request_id, r.status, r.attempt, r.label) for r in got.collect()} == {(1, "ok", 1, GOOD % "a"), (2, "failed", None, None)}


# --- files ---


def tree(folder, files):
    for name, content in files.items():
        os.makedirs(os.path.dirname(f"{folder}/{name}"), exist_ok=True)
        with open(f"{folder}/{name}", "wb") as f:
            f.write(content)


FILES = {"a.txt": b"top", "g_generated/x_positive.swift": b"struct S {}", "g_generated/x_positive.json": b"", "p q/r=1/y@2.txt": b"\xff\xfe", "p q/r=1/z.txt": b"", ".hidden/a.txt": b"no", "p q/_SUCCESS": b""}


def test_files_of_nested_folders(spark, tmp_path):
    tree(tmp_path, FILES)
    rows = listing.read_files(spark, str(tmp_path)).collect()
    want = {n: c for n, c in FILES.items() if not n.startswith(".") and "/_" not in n}
    assert {r.path.removeprefix(f"file:{tmp_path}/"): bytes(r.content) for r in rows} == want
    assert all(r.length == len(r.content) and r.path.startswith("file:/") for r in rows)
    assert {r.path.rpartition("/")[2] for r in listing.read_files(spark, f"file:{tmp_path}", "*.txt", recursive=False).collect()} == {"a.txt"}
    assert not listing.read_files(spark, str(tmp_path), "*.none").count()


def test_folders_are_partitions(spark, tmp_path, monkeypatch):
    tree(tmp_path, {f"d{k}/e{j}/f.txt": b"x" for k in range(6) for j in range(3)})
    reader = listing._FileReader({"path": str(tmp_path)})
    for enough in (1, 5, 20, 256):
        monkeypatch.setattr(listing, "ENOUGH_FOLDERS", enough)
        parts = reader.partitions()
        found = [r for p in parts for b in reader.read(p) for r in b.column(0).to_pylist()]
        assert len(found) == len(set(found)) == 18
    assert listing.read_files(spark, str(tmp_path)).rdd.getNumPartitions() > 6


def test_artifact_files(spark, tmp_path):
    tree(tmp_path, FILES)
    got = {(r.folder, r.base_filename, r.kind): (r.content, r.n_bytes, r.polarity, r.generator) for r in artifacts.read_artifacts(spark, str(tmp_path)).collect()}
    assert got["g_generated", "x_positive", "code"] == ("struct S {}", 11, "positive", "g")
    assert got["g_generated", "x_positive", "label"] == ("", 0, "positive", "g")
    assert got["r=1", "y@2", "prompt"][:2] == (None, 2) and got["r=1", "z", "prompt"][:2] == ("", 0)
    plan = artifacts.read_artifacts(spark, str(tmp_path)).filter(F.col("kind") == "code")._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" not in plan and "Join" not in plan


def test_files_are_written_by_tasks(spark, tmp_path):
    rows = [(f"folder=a@{k % 3}/name=n{k}/part-0.txt", b"x\n" * k) for k in range(40)] + [("folder=a@0/name=n3/part-0.txt", b"y")]
    listing.write_files(spark.createDataFrame(rows, "path string, content binary"), str(tmp_path))
    got = {r.path.removeprefix(f"file:{tmp_path}/"): bytes(r.content) for r in listing.read_files(spark, str(tmp_path), "part-*.txt").collect()}
    assert got.pop("folder=a@0/name=n3/part-0.txt") in (b"x\nx\nx\ny", b"yx\nx\nx\n")
    assert got == {p: c for p, c in rows[:40] if "/name=n3/" not in p}
    assert not [n for _, _, names in os.walk(tmp_path) for n in names if n.startswith("_") or n.endswith(".crc")]


def test_partition_text_is_that_of_sparks_writer(spark, tmp_path):
    values = ["a:b", "c/d", "100%", "", None, "e=f g", "q'\"[x]^{y}?*#\\", "\x01\x1f\x7f", "ü@-_~."]
    df = spark.createDataFrame([(v, str(k)) for k, v in enumerate(values)], "folder string, value string")
    df.write.partitionBy("folder").text(f"{tmp_path}/own")
    want = {n.removeprefix("folder=") for n in os.listdir(f"{tmp_path}/own") if n.startswith("folder=")}
    assert {r[0] for r in df.select(listing.partition_text("folder")).collect()} == want


def test_winner_is_found_without_filters_of_frames():
    import pandas as pd

    class Rows(pd.DataFrame):
        def __getitem__(self, key):
            assert isinstance(key, str)
            return super().__getitem__(key)

    class State:
        exists, kept = False, None

        def update(self, value):
            self.kept = value

    state = State()
    rows = Rows({"request_id": [1, 1, 1], "attempt": [1, 3, 2], "method": [None, "a", "b"], "digest": [None, "x", "y"]})
    assert [f.values.tolist() for f in ingest._keep_first((1,), iter([rows]), state)] == [[[1, 2, "b", "y"]]]
    assert state.kept == (2, "b", "y")


def test_neighbouring_requests_share_a_state(spark, tmp_path):
    """Python is called once for a block of requests and lot, not for each request; a state holds 64 of them at most."""
    ids = [*range(-70, 130), 10**15, 10**15 + 64]
    arrive(spark, tmp_path, "a", [attempt(i, 2, GOOD % "b" if i % 3 else None) for i in ids])
    first = winners(spark, tmp_path)
    assert {i: w[0] for i, w in first.items()} == {i: "ok" if i % 3 else "failed" for i in ids}
    kept = spark.read.format("statestore").load(f"{tmp_path}/progress/winners").selectExpr("size(value.groupState.request_id) AS n").collect()
    assert sum(r.n for r in kept) == len(ids) and max(r.n for r in kept) == 64 and len(kept) == len({i >> 6 for i in ids})
    arrive(spark, tmp_path, "b", [attempt(5, 1, GOOD % "a"), attempt(6, 3, GOOD % "c"), attempt(7, 3, GOOD % "d")])
    now = winners(spark, tmp_path)
    assert {i for i in ids if now[i] != first[i]} == {5, 6} and changes(spark, tmp_path) == len(ids) + 2
