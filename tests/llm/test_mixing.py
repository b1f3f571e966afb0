"""Mixtures against the weights worked out in plain Python."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from basketweave.llm import mixing
from tests.llm.conftest import documents, with_clashes


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(3)
    frames = []
    for at, (source, n) in enumerate((("big", 400), ("mid", 90), ("small", 30), (None, 20))):
        rows = [(1000 * at + i, "w " * rng.randint(1, 40)) for i in range(n)]
        frames.append(documents(spark, rows, source=source))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionAll(f)
    return out.cache()


def totals(rows):
    out = Counter()
    for r in rows:
        out[r["source"]] += len((r["text"] or "").split())
    return out


def weights(sizes, a):
    raised = {s: (t / sum(sizes.values())) ** a for s, t in sizes.items()}
    return {s: x / sum(raised.values()) for s, x in raised.items()}


def entropy(w):
    return -sum(x * math.log(x) for x in w.values())


@pytest.mark.parametrize("options", [{"target_entropy": 0.8}, {"max_repeats": 3.0}, {"target_entropy": 0.99, "max_repeats": 2.0}])
def test_weights_meet_the_target(spark, docs, ws, options):
    sizes = totals(docs.collect())
    low, high = 0.0, 1.0
    for _ in range(60):
        a = (low + high) / 2
        w = weights(sizes, a)
        over = max(w[s] * sum(sizes.values()) / sizes[s] for s in sizes) > options.get("max_repeats", math.inf)
        flat = entropy(w) >= options.get("target_entropy", math.inf) * math.log(len(sizes))
        low, high = (a, high) if over or flat else (low, a)
    goal = weights(sizes, high)
    rows = mixing.mix(docs, ws, **options).collect()
    read = totals(rows)
    for s in sizes:
        quota = goal[s] * sum(sizes.values())
        assert quota - 1 <= read[s] < quota + 41, s
    copies = Counter(r["doc_id"] for r in rows)
    of = {r["doc_id"]: r["source"] for r in rows}
    for s in sizes:
        counts = {copies[d] for d in of if of[d] == s}
        assert max(counts) - min(counts) <= 1
    assert all(0 <= r["mix_position"] < 1 for r in rows)


def test_epochs_are_permutations_of_blocks(spark, docs, ws, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_DOCS", 16)
    monkeypatch.setattr(mixing, "GROUP_BLOCKS", 4)
    rows = mixing.mix(docs, ws, max_repeats=4.0, budget="keep").collect()
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in docs.collect()}
    small = sorted((r["mix_position"], r["doc_id"], r["mix_epoch"]) for r in rows if r["source"] == "small")
    epochs = {}
    for _, d, e in small:
        epochs.setdefault(e, []).append(d)
    assert [e for _, _, e in small] == sorted(e for _, _, e in small)
    assert sorted(epochs[0]) == sorted(epochs[1]) and epochs[0] != epochs[1]
    # Positions are the tokens that were read before, as a share of the quota.
    size = {r["doc_id"]: len(r["text"].split()) for r in rows}
    at, quota = 0, None
    for position, d, _ in small:
        quota = quota or (at and at / position)
        assert not quota or abs(position - at / quota) < 1e-9
        at += size[d]


def test_natural_shares_and_a_budget(spark, docs, ws):
    once = mixing.mix(docs, ws).collect()
    assert Counter(r["doc_id"] for r in once) == Counter(r["doc_id"] for r in docs.collect())
    some = totals(mixing.mix(docs, ws, budget=1000).collect())
    assert 1000 - 4 <= sum(some.values()) < 1000 + 4 * 41


def test_odd_rows(spark, ws):
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "c"), (None, "c"), (4, "x " * 100_000)]
    docs = with_clashes(documents(spark, rows).unionAll(documents(spark, [(9, None), (10, "")], source="e")))
    mixed = mixing.mix(docs, ws, max_repeats=2.0, budget="keep")
    assert set(docs.columns) < set(mixed.columns)
    assert mixed.count() == 9
    assert mixing.mix(docs.limit(0), ws, target_entropy=0.9).collect() == []
    blank = mixing.mix(docs.where("doc_id IN (9, 10)"), ws, target_entropy=0.9, max_repeats=2.0)
    assert sorted(r["doc_id"] for r in blank.collect()) == [9, 10]
    plan = mixed.select(F.col("doc_id"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
