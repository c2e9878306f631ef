"""Snapshots in buckets: no shuffle where rows of a key meet, and updates of the touched buckets only."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from tessella.operators import audit, resume
from tessella.sources import bucketed

SCHEMA = "generator string, base_filename string, kind string, content string"
LABEL = '{"reasoning":"r","identifiers":[]}'
TABLES = iter(range(1000))


def name():
    return f"bucketed_test_{os.getpid()}_{next(TABLES)}"


def rows(n=40):
    out = []
    for i in range(n):
        key = ("g%d" % (i % 3), "s%d_positive" % i)
        out += [(*key, "code", "let a = 1"), (*key, "prompt", "no symbols"), (*key, "symbols", "[]")]
        if i % 2:
            out.append((*key, "label", LABEL))
    return out


@pytest.fixture
def joined(spark):
    """No broadcast joins, so that every exchange that is needed shows."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def files(path):
    return {os.path.relpath(f, path): os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/*/*.parquet")}


def as_set(df):
    return sorted(df.collect(), key=repr)


def test_layout(spark, tmp_path):
    assert [bucketed.buckets_for(n) for n in (0, 1, 256 << 20, (256 << 20) + 1, 100 << 40, 1 << 60)] == [1, 1, 1, 2, bucketed.MOST_BUCKETS, bucketed.MOST_BUCKETS]
    stored = bucketed.write(spark.createDataFrame(rows(), SCHEMA), name(), str(tmp_path / "t"), buckets=8)
    assert sorted(map(tuple, stored.collect())) == sorted(rows())
    folders = [f.split("/")[0] for f in files(tmp_path / "t")]
    assert len(folders) == len(set(folders)) <= 8  # one file a bucket


def test_state_and_assembly_need_no_exchange(joined, tmp_path):
    data = joined.createDataFrame(rows(), SCHEMA)
    stored = bucketed.write(data, name(), str(tmp_path / "a"), buckets=8)
    wanted = bucketed.write(data.select(*bucketed.KEYS).distinct(), name(), str(tmp_path / "s"), buckets=8)
    state = resume.work_state(wanted, stored)
    assert "Exchange" not in plan(state)
    assert {r.base_filename: r.state for r in state.collect()} == {f"s{i}_positive": "complete" if i % 2 else "reuse_code" for i in range(40)}
    open_samples = resume.pending(wanted, resume.completed(stored))
    assert "Exchange" not in plan(open_samples) and open_samples.count() == 20
    entries, rejects = resume.assemble(stored, keys=bucketed.KEYS)
    assert "Exchange" not in plan(entries) and entries.count() == 20 and rejects.count() == 0
    pruned = bucketed._without(stored, audit.flagged(stored), bucketed.KEYS, ["kind"])
    text = plan(pruned.select(*bucketed.KEYS, "content"))
    assert "Exchange" not in text.split("== Initial Plan ==")[0]  # planned for null keys, of which there are none
    assert pruned.count() == len(rows()) - 20


def test_symbols_as_artifacts_or_as_a_table(spark):
    data = spark.createDataFrame([*rows(), ("g", "x", "code", "c"), ("g", "x", "label", LABEL), ("g", "x", "symbols", "")], SCHEMA)
    apart = data.where("kind = 'symbols'").select(*bucketed.KEYS, F.col("content").alias("symbols_json"))
    rest = data.where("kind <> 'symbols'")
    assert as_set(resume.artifact_state(data)) == as_set(resume.artifact_state(rest, apart))
    assert as_set(resume.judge(data, keys=bucketed.KEYS)) == as_set(resume.judge(rest, apart, bucketed.KEYS))
    for mine, theirs in zip(resume.assemble(data, keys=bucketed.KEYS), resume.assemble(rest, apart, bucketed.KEYS), strict=True):
        assert as_set(mine) == as_set(theirs)


def test_update_touches_its_buckets_only(spark, tmp_path):
    table, path = name(), str(tmp_path / "t")
    bucketed.write(spark.createDataFrame(rows(), SCHEMA), table, path, buckets=8)
    before = files(path)
    new = spark.createDataFrame([("g1", "s1_positive", "label", "new"), ("g1", "s1_positive", "note", "added")], SCHEMA)
    for _ in range(2):  # a repeated update changes nothing more
        assert bucketed.update(new, table, ["kind"]) == 1
        want = [r for r in rows() if r[1:3] != ("s1_positive", "label")] + [tuple(r) for r in new.collect()]
        assert sorted(map(tuple, bucketed.read(spark, table).collect())) == sorted(want)
    after = files(path)
    gone = {f.split("/")[0] for f in before.items() ^ after.items() for f in [f[0]]}
    assert len(gone) == 1 and len(after) == len(before)
    assert bucketed.update(new.limit(0), table, ["kind"]) == 0 and files(path) == after


def test_updated_table_still_needs_no_exchange(joined, tmp_path):
    table, path = name(), str(tmp_path / "t")
    bucketed.write(joined.createDataFrame(rows(), SCHEMA), table, path, buckets=8)
    bucketed.update(joined.createDataFrame([("g9", "fresh", "code", "c")], SCHEMA), table, ["kind"])
    state = resume.artifact_state(bucketed.read(joined, table))
    assert "Exchange" not in plan(state) and state.count() == 41


def test_several_updates_of_one_place(spark, tmp_path):
    table = name()
    bucketed.write(spark.createDataFrame(rows(4), SCHEMA), table, str(tmp_path / "t"), buckets=4)
    twice = spark.createDataFrame([("g1", "s1_positive", "label", "a", 1), ("g1", "s1_positive", "label", "b", 2), ("g1", "s1_positive", "label", "z", None)], SCHEMA + ", at int")
    with pytest.raises(ValueError, match="several updates"):
        bucketed.update(twice, table, ["kind"])
    bucketed.update(twice, table, ["kind"], order="at")
    assert [r.content for r in bucketed.read(spark, table).where("base_filename = 's1_positive' and kind = 'label'").collect()] == ["b"]


def test_null_keys_are_one_value(spark, tmp_path):
    table = name()
    odd = [(None, None, None, "x"), ("g", None, "code", None), ("g", "s", None, "y")]
    bucketed.write(spark.createDataFrame(odd, SCHEMA), table, str(tmp_path / "t"), buckets=4)
    for _ in range(2):
        bucketed.update(spark.createDataFrame([(None, None, None, "new"), ("g", "s", None, "other")], SCHEMA), table, ["kind"])
        assert as_set(bucketed.read(spark, table)) == as_set(spark.createDataFrame([(None, None, None, "new"), ("g", None, "code", None), ("g", "s", None, "other")], SCHEMA))


def test_remove_and_empty_buckets(spark, tmp_path):
    table, path = name(), str(tmp_path / "t")
    data = spark.createDataFrame(rows(), SCHEMA)
    bucketed.write(data, table, path, buckets=8)
    number = len(files(path))
    chosen = data.select(*bucketed.KEYS, F.pmod(F.hash(*bucketed.KEYS), F.lit(8)).alias("b"))
    one = chosen.first().b
    assert bucketed.remove(chosen.where(F.col("b") == one), table) == 1
    want = data.where(F.pmod(F.hash(*bucketed.KEYS), F.lit(8)) != one)
    assert as_set(bucketed.read(spark, table)) == as_set(want)
    assert spark.read.table(table).where(f"_bucket = {one}").count() == 0 and spark.sql(f"SHOW PARTITIONS {table}").count() == number - 1
    assert bucketed.remove(chosen.limit(0), table) == 0


def test_empty_table_and_clashing_column(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    table = name()
    stored = bucketed.write(empty, table, str(tmp_path / "t"), buckets=4)
    assert stored.columns == empty.columns and stored.count() == 0
    bucketed.update(spark.createDataFrame(rows(2), SCHEMA), table, ["kind"])
    assert sorted(map(tuple, bucketed.read(spark, table).collect())) == sorted(rows(2))
    with pytest.raises(ValueError, match="_bucket"):
        bucketed.write(empty.withColumn("_bucket", F.lit(1)), name(), str(tmp_path / "u"))


def test_attach_what_another_session_wrote(joined, tmp_path):
    path = str(tmp_path / "t")
    data = joined.createDataFrame(rows(), SCHEMA)
    bucketed.write(data, name(), path, buckets=8)
    again = name()
    found = bucketed.attach(joined, again, path, data.schema, buckets=8)
    state = resume.artifact_state(found)
    assert "Exchange" not in plan(state) and state.count() == 40
    assert bucketed.update(joined.createDataFrame([("g", "n", "code", "c")], SCHEMA), again, ["kind"]) == 1
    assert bucketed.read(joined, again).count() == len(rows()) + 1


def test_number_of_buckets_grows_with_the_texts(spark, monkeypatch):
    from tessella.plans import registry
    from tessella.sources import bucketed

    rows = spark.createDataFrame([("a", None, "x" * 3000), (None, b"yy", "é" * 1000), ("b", b"", "")], "k string, b binary, content string")
    assert bucketed.text_bytes(rows) == 5004
    fewest = max(8, spark.sparkContext.defaultParallelism)
    assert registry._number_of_buckets(spark, rows) == fewest
    monkeypatch.setattr(bucketed, "BUCKET_BYTES", 20)
    assert registry._number_of_buckets(spark, rows) == 256
    assert bucketed.text_bytes(rows.limit(0)) == 0
