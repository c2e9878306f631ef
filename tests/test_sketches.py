"""Sketches of lots against exact values, merged in any order."""

import json
import random

import pytest

from tessella.operators import analytics, sketches
from tessella.session import materialize


def parsed(spark, rows):
    """Outputs of (dataset, identifiers or None for an output that is no label, reasoning)."""
    made = [(d, i, "x" if ids is None else json.dumps({"reasoning": why, "identifiers": ids})) for i, (d, ids, why) in enumerate(rows)]
    return analytics.parse_outputs(spark.createDataFrame(made, "dataset string, entry_id long, output string"))


def stats(lots):
    return {r.dataset: r for r in sketches.estimates(sketches.merged(lots)).collect()}


def test_small_lots_are_exact(spark):
    rows = [("a", ["x", "y", "x"], "long"), ("a", ["x"], "longer"), ("a", None, ""), ("a", [], "l"), ("b", None, "")]
    one = stats([sketches.lot_sketches(parsed(spark, rows))])
    two = stats([materialize(sketches.lot_sketches(parsed(spark, part)), "lot") for part in (rows[:1], rows[1:3], rows[3:])])
    assert one == two
    a, b = one["a"], one["b"]
    assert (a.total, a.valid, a.instances, a.unique_ids) == (4, 3, 4, 2)
    assert [(t.identifier, t.n) for t in a.top] == [("x", 3), ("y", 1)]
    assert a.median_items in (1, 3) and a.median_reasoning == 4
    assert (b.total, b.valid, b.instances, b.unique_ids, b.median_items, b.median_reasoning) == (1, 0, 0, 0, None, None)


@pytest.mark.parametrize("seed", [1, 2])
def test_large_lots_are_within_their_bounds(spark, seed):
    rng = random.Random(seed)
    rows = [("d", [f"w{int(rng.paretovariate(0.6)) % 30_000}" for _ in range(rng.randint(1, 30))], "r" * rng.randint(0, 3000)) for _ in range(4000)]
    got = stats([sketches.lot_sketches(parsed(spark, rows[k::4])) for k in (2, 0, 3, 1)])["d"]
    uses = [x for _, ids, _ in rows for x in ids]
    assert (got.total, got.instances) == (4000, len(uses))
    assert abs(got.unique_ids / len(set(uses)) - 1) < 0.06
    for value, all_ in ((got.median_items, [len(i) for _, i, _ in rows]), (got.median_reasoning, [len(r) for *_, r in rows])):
        below, upto = sum(x < value for x in all_), sum(x <= value for x in all_)
        assert below / len(all_) <= 0.53 and upto / len(all_) >= 0.47
    exact = {x: uses.count(x) for x in {t.identifier for t in got.top}}
    assert all(abs(t.n - exact[t.identifier]) <= 3 * len(uses) / sketches.TRACKED for t in got.top)
