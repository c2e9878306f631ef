"""Prefix tries, list ranks and running sums against plain versions, with ranges and lists small enough to be cut."""

import collections
import hashlib
import random
import re
import zlib

import pytest
from helpers import clashing
from pyspark.sql import functions as F

from tessella.llm import ordered, tries
from tessella.llm.queries import REGISTRY

TURNS = "conv_id long, turn long, role string, text string"


@pytest.fixture
def cut(monkeypatch):
    """Ranges of a few rows, and lists that one task does not rank."""
    monkeypatch.setattr(ordered, "RANGE_ROWS", 40)
    monkeypatch.setattr(ordered, "STRIDE", 4)
    monkeypatch.setattr(ordered, "SMALL", 20)


def plain_trie(rows):
    convs = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append(((turn is not None, turn or 0), role or "", text or ""))
    convs = {c: [x[1:] for x in sorted(t, key=lambda x: (x[0], hashlib.sha256(f"{len(x[1])}:{x[1]}{x[2]}".encode()).hexdigest()))] for c, t in convs.items()}
    built = {}
    for c, t in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(convs.get(c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20)), [])[:h] + t[h:])
    members = collections.defaultdict(list)
    for c, t in built.items():
        for d in range(len(t) + 1):
            members[t[:d]].append(c)
    out = {}
    for path, ids in members.items():
        below = [p for p in members if p[: len(path)] == path]
        kids = lambda p: [q for q in members if len(q) == len(p) + 1 and q[: len(p)] == p]
        saved = sum((len(members[p]) - 1) * len(re.findall("[^\x20\x09-\x0d]+", p[-1][1])) for p in below if p)
        ends = ",".join(str(c) for c in sorted(ids) if len(built[c]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        out[min(ids), len(path)] = (parent, len(ids), len(kids(path)), sum(not kids(p) for p in below), saved, hashlib.sha256(ends.encode()).hexdigest())
    return out


def found(spark, rows):
    got = tries.trie(clashing(spark.createDataFrame(rows, TURNS))).collect()
    out = {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in got}
    assert len(out) == len(got)
    return out


def conversations(seed, n=60, words=("a b", "a  b", "c", "d e f")):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "assistant"]), rng.choice(words)) for c in range(n) for t in range(rng.randint(1, 5))]


def test_trie_of_shared_prefixes(spark, cut):
    rows = conversations(1)
    assert found(spark, rows) == plain_trie(rows)


def test_trie_of_odd_rows(spark, cut):
    rows = conversations(2, 25)
    rows += [(None, 0, "user", "x"), (3, None, None, None), (3, None, "user", None), (41, 5, None, "same"), (41, 5, None, "same"), (41, 5, None, "other")]
    rows += [(-7, 0, "user", "a b"), (-20, 0, "user", "c"), (-20, 1, "user", "d"), (-20, 2, "user", "e"), (2**62, 0, "user", "long " * 30_000)]
    assert found(spark, rows) == plain_trie(rows)


def test_trie_with_one_conversation_of_a_third_of_all_rows(spark, cut):
    rows = conversations(3, 30) + [(500, t, "user", f"w{t % 3}") for t in range(120)] + [(600 + c, 0, "user", "same") for c in range(100)]
    assert found(spark, rows) == plain_trie(rows)


def test_trie_of_copies(spark, cut):
    rows = [(c, t, "user", f"w{t}") for c in range(1000, 1090) for t in range(3)] + [(7, 0, "user", "equal")] * 90
    assert found(spark, rows) == plain_trie(rows)


def test_trie_of_nothing(spark):
    assert found(spark, []) == {}


def test_trie_query(spark):
    import duckdb

    sf = "/root/testdata/sf0.01"
    rows = duckdb.connect().execute(f"SELECT conv_id, turn, role, text FROM '{sf}/conversations.parquet'").fetchall()
    got = REGISTRY["op13_prefix_trie"](spark, sf).collect()
    assert {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in got} == plain_trie(rows)


@pytest.mark.parametrize("group", [None, "g"])
def test_running_sums(spark, cut, group):
    rng = random.Random(4)
    rows = [(rng.choice([1, 1, 1, 2, 3, 2**40]), i, rng.randint(-5, 50)) for i in range(700)]
    rng.shuffle(rows)
    order = ["i"] if group else ["g", "i"]
    got = ordered.running(spark.createDataFrame(rows, "g long, i long, x long"), group, order, ["x"], "t").collect()
    place, total = collections.Counter(), collections.Counter()
    want = {}
    for g, i, x in sorted(rows):
        k = g if group else 0
        total[k] += x
        want[g, i] = (place[k], total[k])
        place[k] += 1
    assert {(r.g, r.i): (r.place, r.run_x) for r in got} == want
    assert not ordered.running(spark.createDataFrame([], "g long, i long, x long"), group, order, ["x"], "t").count()


@pytest.mark.parametrize("sizes", [[], [1], [1, 7, 1, 300], [900]])
def test_list_ranks(spark, cut, sizes):
    items = list(range(sum(sizes)))
    random.Random(5).shuffle(items)
    rows, want, at = [], {}, 0
    for n in sizes:
        own = items[at : at + n]
        at += n
        rows += [(x, own[k + 1] if k + 1 < n else None) for k, x in enumerate(own)]
        want |= {x: n - 1 - k for k, x in enumerate(own)}
    got = ordered.list_ranks(spark.createDataFrame(rows, "item long, next long")).collect()
    assert {r.item: r.rest for r in got} == want and len(got) == len(want)


def test_subtree_sums_of_a_path_and_a_star(spark, cut):
    path = [(k, k - 1 if k else None, 0, 1) for k in range(60)]
    star = [(0, None, 0, 1)] + [(k, 0, k - 1, 1) for k in range(1, 60)]
    for rows, want in ((path, {k: 60 - k for k in range(60)}), (star, {0: 60} | dict.fromkeys(range(1, 60), 1))):
        got = tries.subtree_sums(spark.createDataFrame(rows, "number long, parent long, sibling long, v long"), ["v"]).collect()
        assert {r.number: r.sub_v for r in got} == want


def test_digest_of_many_ends_is_streamed(spark):
    ids = list(range(-5000, 20_000, 3))
    got = tries.digests(spark.createDataFrame([("k", i) for i in ids] + [("j", 4)], "key string, conv_id long")).collect()
    assert {r.key: r.ends_sha256 for r in got} == {"k": hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), "j": hashlib.sha256(b"4").hexdigest()}


def test_no_python_reads_turns(spark):
    """Texts stay in the JVM; only numbers and identities pass through Python."""
    plan = tries.turns(spark.createDataFrame([(1, 0, "user", "a")], TURNS)).filter(F.lit(True))._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" not in plan
