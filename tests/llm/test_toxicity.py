"""Segments against brute force, and a model on planted words."""

import random

import numpy as np
from pyspark.sql import functions as F

from basketweave.llm import toxicity
from tests.llm.conftest import documents, with_clashes


def plain_segments(scores, offset=0):
    """Ruzzo and Tompa's definition: the best segment, then both sides of it."""
    if not len(scores) or max(scores) <= 0:
        return []
    best = max(
        ((i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)),
        key=lambda x: (round(sum(scores[x[0] : x[1]]), 9), x[0] - x[1]),
    )
    i, j = best
    return (
        plain_segments(scores[:i], offset)
        + [(offset + i, offset + j)]
        + plain_segments(scores[j:], offset + j)
    )


def test_segments_are_all_maximal_ones():
    rng = random.Random(1)
    for _ in range(300):
        scores = [rng.choice([-3.1, -1.3, -0.52, 0.71, 1.17, 2.03]) for _ in range(rng.randint(0, 18))]
        found = toxicity.segments(np.array(scores))
        assert [(a, b) for a, b, _ in found] == plain_segments(scores)
        assert all(abs(s - sum(scores[a:b])) < 1e-9 for a, b, s in found)


def test_a_long_scan_is_linear():
    scores = np.tile([1.0, -0.9], 200_000)
    assert toxicity.segments(scores)[0][:2] == (0, 399_999)
    assert len(toxicity.segments(np.tile([1.0, -2.0], 200_000))) == 200_000


def planted(spark, vocabulary, n=600):
    rng = random.Random(9)
    texts, labels = [], []
    for i in range(n):
        words = rng.choices(vocabulary, k=rng.randint(20, 120))
        toxic = i % 5 == 0
        if toxic:
            for _ in range(4):
                words[rng.randrange(len(words))] = rng.choice(["vilezz", "grumq"]) + rng.choice("abcd")
        texts.append(" ".join(words))
        labels.append((i, 1, int(toxic)))
    frame = spark.createDataFrame(labels, "doc_id BIGINT, quality INT, toxic INT")
    return documents(spark, texts), frame, labels


def test_held_out_documents(spark, vocabulary, ws):
    docs, frame, labels = planted(spark, vocabulary)
    model = toxicity.fit(docs, frame, ws)
    rows = toxicity.score(docs, model).collect()
    right = [(r["score"] >= 0.7) == bool(labels[r["doc_id"]][2]) for r in rows]
    assert np.mean(right) > 0.97
    out = {r[0] for r in docs.where(toxicity.held_out(docs["doc_id"])).select("doc_id").collect()}
    assert np.mean([x for x, r in zip(right, rows, strict=True) if r["doc_id"] in out]) > 0.95
    kept = toxicity.drop_toxic(with_clashes(docs), model)
    assert kept.columns == with_clashes(docs).columns
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} == {
        r["doc_id"] for r in rows if r["score"] < 0.7
    }


def test_odd_rows(spark, vocabulary, ws):
    docs, frame, _ = planted(spark, vocabulary, 200)
    odd = [(900, None), (901, ""), (902, "!!"), (None, "vilezza grumqb vilezzc"), (903, "vilezza " * 60_000)]
    odd += [(904, "grumqa grumqb vilezzb"), (904, "plain words")]
    docs = with_clashes(docs.unionAll(documents(spark, odd)))
    labels = with_clashes(
        frame.unionAll(
            spark.createDataFrame([(900, 1, 1), (0, 1, None), (None, 1, 1), (904, 0, 1), (5, 1, 0)], frame.schema)
        )
    )
    model = toxicity.fit(docs, labels, ws)
    found = toxicity.score(docs, model).collect()
    assert len(found) == 207 and all(0 <= r["score"] <= 1 for r in found)
    score = {r["doc_id"]: r["score"] for r in found}
    assert max(score[900], score[901], score[902]) < 0.3 and min(score[903], score[None]) > 0.7
    assert toxicity.drop_toxic(docs, model).where("doc_id = 904").count() == 1
    empty = toxicity.fit(docs.limit(0), labels, ws)
    assert not empty.features
    assert all(r["score"] < 0.5 for r in toxicity.score(docs, empty).collect())
    assert toxicity.score(docs.limit(0), model).collect() == []
    assert not toxicity.fit(docs, labels.limit(0), ws).features


def test_every_feature_counts_however_many(spark, vocabulary, ws, monkeypatch):
    docs, frame, _ = planted(spark, vocabulary, 200)
    docs = with_clashes(docs.unionAll(documents(spark, [(900, None), (901, ""), (None, "vilezza grumqb"), (5, "to")])))
    plain = toxicity.fit(docs, frame, ws)
    kept = sorted(map(str, toxicity.drop_toxic(docs, plain).collect()))
    monkeypatch.setattr(toxicity, "fits_broadcast", lambda *_: False)
    large = toxicity.fit(docs, frame, ws)
    assert plain.features and not plain.table and not large.features
    assert {r["feature"] for r in large.table.df.collect()} == set(plain.features)
    assert abs(large.weight - plain.weight) < 1e-9 and abs(large.slope - plain.slope) < 1e-9
    found = {(r["doc_id"], round(r["score"], 9), r["passages"]) for r in toxicity.score(docs, large).collect()}
    assert found == {(r["doc_id"], round(r["score"], 9), r["passages"]) for r in toxicity.score(docs, plain).collect()}
    assert sorted(map(str, toxicity.drop_toxic(docs, large).collect())) == kept


def test_more_features_than_fifty_thousand(spark, ws):
    rows = [(f"w{i}", 100, 0) for i in range(50_100)]
    counts = spark.createDataFrame(rows, "feature STRING, y1 BIGINT, y0 BIGINT")
    table = ws.write("counts", counts, y1=F.sum("y1"), y0=F.lit(5_010_000).cast("bigint") + F.sum("y0"))
    assert len(toxicity._log_odds(table, ws).features) == 50_100
