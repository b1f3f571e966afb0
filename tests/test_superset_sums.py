"""Subsets summed as bit masks."""

import itertools
import random
from collections import Counter

import pytest

import basketweave as bw
from basketweave.plans import growth
from tests.conftest import brute_force, collected, rows_frame


@pytest.mark.parametrize("items", [1, 2, 5, 8])
def test_every_set_gets_the_weight_of_its_supersets(spark, items):
    rng = random.Random(items)
    half = -(-items // 2)
    weights = Counter()
    for _ in range(40):
        weights[rng.randrange(2), rng.randrange(1 << items)] += rng.randint(1, 5)
    rows = [(k, m >> half, m & ((1 << half) - 1), w) for (k, m), w in weights.items()]
    frame = spark.createDataFrame(rows, "k INT, high INT, low INT, w BIGINT")
    found = growth.superset_sums(frame, ["k"], items).collect()
    got = {(r["k"], r["high"] << half | r["low"]): r["w"] for r in found}
    want = {}
    for k, m in itertools.product(range(2), range(1 << items)):
        total = sum(w for (a, b), w in weights.items() if a == k and b & m == m)
        if total:
            want[k, m] = total
    assert got == want and len(found) == len(got)


def test_two_shuffles_and_no_listed_subsets(spark):
    frame = spark.createDataFrame([([0, 1, 2, 3, 4, 5], [9], 1)], "prefix ARRAY<INT>, suffix ARRAY<INT>, w BIGINT")
    plan = growth._count_subsets(frame, 1, 2, None, growth.MASK_ITEMS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 4
    assert "explode(filter(aggregate" not in plan and "reduce" not in plan.split("explode(")[-1]
    listed = growth._count_subsets(frame, 1, 2, None)._jdf.queryExecution().executedPlan().toString()
    assert listed != plan


@pytest.mark.parametrize("limit", [0, 30])
@pytest.mark.parametrize("width", [2, 14])
def test_masks_and_lists_agree(spark, monkeypatch, limit, width):
    monkeypatch.setattr(growth, "MASK_ITEMS", limit)
    rng = random.Random(5)
    baskets = [rng.sample("abcdefghijkl", rng.randint(0, 8)) for _ in range(70)]
    found = growth.mine_subsets(bw.Workspace(spark), rows_frame(spark, baskets), 3, subset_width=width)
    assert collected(found) == brute_force(baskets, 3)
