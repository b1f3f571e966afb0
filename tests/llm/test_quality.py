import math
import random
import zlib

import numpy as np
import pytest

from basketweave.llm import quality
from tests.llm.conftest import documents, with_clashes

LABELS = "doc_id BIGINT, quality INT, toxic INT"


def corpus(n, seed=4):
    """Prose and junk: marks, capitals and tables, as texts with labels."""
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdeilmnorstu", k=rng.randint(2, 8))) for _ in range(900)]
    rows = []
    for i in range(n):
        found = rng.choices(words, k=rng.randint(5, 80))
        label = int(rng.random() < 0.8)
        if not label:
            junk = rng.randrange(3)
            found = [w + "&&&" for w in found] if junk == 0 else [w.upper() + "!!" for w in found] if junk == 1 else " | ".join(found).split(" ")
        rows.append((i, " ".join(found) + ".", label))
    return rows


def frames(spark, rows):
    docs = documents(spark, [(i, t) for i, t, _ in rows])
    return docs, spark.createDataFrame([(i, y, 0) for i, _, y in rows], LABELS)


@pytest.fixture(scope="module")
def rows():
    return corpus(700)


@pytest.fixture(scope="module")
def fitted(spark, rows):
    from basketweave.workspace import Workspace

    return quality.fit(*frames(spark, rows), Workspace(spark))


def kept(i):
    return zlib.crc32(str(i).encode()) % 3 != 1


def test_held_out_accuracy(spark, rows, fitted):
    docs, _ = frames(spark, rows)
    found = {r["doc_id"]: r["score"] for r in quality.score(with_clashes(docs), fitted).collect()}
    held = [(found[i] >= quality.THRESHOLD) == (y == 1) for i, _, y in rows if not kept(i)]
    assert len(held) > 150 and sum(held) / len(held) > 0.97
    assert all(0 <= s <= 1 for s in found.values())


def test_counts_agree_with_brute_force(spark, ws, rows):
    docs, labels = frames(spark, rows[:80])
    got = {r["bucket"]: (r["y1"], r["y0"]) for r in quality._counts(quality._labelled(docs, labels, ws)).collect()}
    want = {}
    for i, text, label in rows[:80]:
        if kept(i):
            for bucket in [-1, *quality.features(text).tolist()]:
                y1, y0 = want.get(bucket, (0, 0))
                want[bucket] = (y1 + label, y0 + 1 - label)
    assert got == want


def test_descent_reaches_the_optimum():
    """Weak duality: the primal and the dual value meet."""
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 30, 6)) for _ in range(120)]
    ratios = rng.normal(size=30)
    signs = np.where([(ratios[s].sum() + rng.normal() > 0) for s in sets], 1.0, -1.0)
    costs = np.full(120, 0.7)
    found = quality.descend(sets, signs, ratios, costs)
    rows = np.zeros((120, 31))
    for i, s in enumerate(sets):
        rows[i, s] = ratios[s] / math.sqrt(len(s))
        rows[i, 30] = 1

    def primal(w):
        return w @ w / 2 + (costs * np.maximum(0, 1 - signs * (rows @ w))).sum()

    best, w = primal(found), np.zeros(31)
    for t in range(1, 30_000):  # plain subgradient steps come no lower
        broken = signs * (rows @ w) < 1
        w -= (w - (costs * signs * broken) @ rows) / (t + 50)
    assert best <= primal(w) * 1.001


def test_features():
    assert quality.features(None).tolist() == quality.features("").tolist() != []
    assert quality.features("one two").tolist() != quality.features("two one").tolist()
    assert [quality.shape(t) for t in ("word", "WORD", "Word", "12", "&&&", "\n\n", "!")] == [
        "a3", "A3", "Aa3", "02", "&2", "n", "!",
    ]
    long = quality.features("word " * 200_000)
    assert len(long) < 40 and long.max() < quality.BUCKETS


def test_labels_that_do_not_count(spark, ws, rows, fitted):
    docs, labels = frames(spark, rows)
    wrong = spark.createDataFrame(
        [(i, 1 - y, 0) for i, _, y in rows if not kept(i)] + [(None, 0, 0), (5, None, 1), (5, 7, 1)], LABELS
    )
    own = labels.where(~quality.held_out(labels["doc_id"]))
    again = quality.fit(docs, own.unionAll(wrong), ws)
    assert np.array_equal(again.weights, fitted.weights) and again.shift == fitted.shift


def test_one_class_empty_tables_and_odd_rows(spark, ws, rows, fitted):
    docs, labels = frames(spark, rows[:50])
    assert [r["score"] for r in quality.score(docs, quality.fit(docs, labels.where("quality = 1"), ws)).collect()] == [0.5] * 50
    assert quality.score(documents(spark, []), fitted).collect() == []
    assert (quality.fit(documents(spark, []), labels.limit(0), ws).weights == 0).all()
    odd = documents(spark, [(1, None), (1, ""), (None, "x " * 300_000), (2, "漢字 \x00")])
    scores = [r["score"] for r in quality.score(odd, fitted).collect()]
    assert len(scores) == 4 and scores[0] == scores[1]


def test_sample_is_bounded(spark, ws, rows, monkeypatch):
    monkeypatch.setattr(quality, "SAMPLE", 40)
    labelled = quality._labelled(*frames(spark, rows), ws)
    whole, marks = quality._sample(labelled, ws)
    assert sorted(marks) == [0] * 40 + [1] * 40
    monkeypatch.setattr(quality, "SAMPLE_FEATURES", 2000)
    part, _ = quality._sample(labelled, ws)
    assert [p.tolist() for p in part] == [w.tolist() for w in whole[: len(part)]]
    assert 0 < sum(map(len, part)) <= 2000
