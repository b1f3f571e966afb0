"""The random field against enumeration, and on made languages that mix."""

import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from basketweave.llm import language
from tests.llm.conftest import DOCUMENT, with_clashes


def test_marginals_are_exact(monkeypatch):
    monkeypatch.setattr(language, "BLOCK", 3)
    rng = np.random.default_rng(5)
    lengths, size = [1, 5, 3, 7], 3
    scores, moves = rng.normal(size=(16, size)) * 3, rng.normal(size=(size, size)) * 2
    first = np.zeros(16, bool)
    first[np.cumsum([0] + lengths[:-1])] = True
    found, at = language.marginals(scores, first, moves), 0
    for n in lengths:
        weight = np.zeros((n, size))
        for labels in itertools.product(range(size), repeat=n):
            total = sum(scores[at + i, y] for i, y in enumerate(labels))
            total += sum(moves[a, b] for a, b in zip(labels, labels[1:], strict=False))
            weight[range(n), labels] += np.exp(total)
        assert np.allclose(found[at : at + n], weight / weight.sum(axis=1, keepdims=True))
        at += n


def test_training_gradients_match_marginals():
    rng = np.random.default_rng(6)
    scores, moves = rng.normal(size=(2, 6, 3)), rng.normal(size=(3, 3))
    nodes, pairs = language._expected(scores, moves)
    first = np.array([True] + [False] * 5)
    for i in range(2):
        assert np.allclose(nodes[i], language.marginals(scores[i], first, moves))
    assert abs(pairs.sum() - 10) < 1e-9


SYLLABLES = {"aa": "ka to mi ru sen hal", "bb": "ska to vren mi lo dj", "cc": "qu ée ri to ço lau"}


def prose(rng, lang, n):
    return " ".join(
        "".join(rng.choices(SYLLABLES[lang].split(), k=rng.randint(1, 4))) for _ in range(n)
    )


def test_held_out_accuracy_and_odd_rows(spark):
    rng = random.Random(7)
    rows = []
    for i in range(240):
        lang = rng.choice(list(SYLLABLES))
        rows.append((i, prose(rng, lang, rng.randint(8, 60)), lang, "s", 0))
    mixed = f"{prose(rng, 'aa', 70)} {prose(rng, 'cc', 30)}"
    odd = [
        (900, None, "aa"), (901, "", "aa"), (902, "12 !? ²½", "bb"), (903, mixed, None),
        (None, prose(rng, "bb", 20), "bb"), (904, prose(rng, "bb", 60_000), "bb"), (5, "to", "aa"),
        (905, "x", "cc"),
    ]
    docs = with_clashes(
        spark.createDataFrame([*rows, *((i, t, x, "s", 0) for i, t, x in odd)], DOCUMENT)
    )
    model = language.fit(docs)
    found = language.identify(docs, model).collect()
    assert len(found) == 248 and all(0 <= r["score"] <= 1 for r in found)
    by = {r["doc_id"]: r for r in found if r["doc_id"] != 5}
    out = {r[0] for r in docs.where(language.held_out(F.col("doc_id"))).select("doc_id").collect()}
    right = [by[i]["lang_pred"] == x for i, _, x, *_ in rows if i in out and i != 5]
    assert len(right) > 40 and np.mean(right) > 0.95
    assert {by[i]["lang_pred"] for i in (900, 901, 902)} == {"und"}
    assert by[904]["lang_pred"] == by[None]["lang_pred"] == "bb"
    shares = dict(x.split(":") for x in by[903]["languages"].split(","))
    assert abs(float(shares["aa"]) - 0.7) < 0.1 and abs(float(shares["cc"]) - 0.3) < 0.1
    none = language.fit(docs.limit(0))
    assert {r["lang_pred"] for r in language.identify(docs, none).collect()} == {"und"}
    assert language.identify(docs.limit(0), model).collect() == []


def test_a_run_without_blanks_counts_whole():
    rng = random.Random(8)
    sample = [(x, prose(rng, x, 150).split()) for x in SYLLABLES for _ in range(20)]
    emitter = language.Emitter(language.train(sample))
    run = "".join(rng.choices(SYLLABLES["aa"].split(), k=20))[:40]
    run += "".join(rng.choices(SYLLABLES["cc"].split(), k=400))
    assert "".join(language.words(run)) == run and max(map(len, language.words(run))) <= 40
    (best, _, mixed), = language.label([run], emitter)
    assert best == "cc" and float(dict(x.split(":") for x in mixed.split(","))["cc"]) > 0.8


def test_more_languages_than_64(spark):
    rng = random.Random(10)
    letters = "bcdfghjklmnpqrstvwxz"
    names = [f"l{i:02}" for i in range(70)]
    own = {x: [letters[i % 20] + letters[i // 20 + j] + "a" for j in range(3)] for i, x in enumerate(names)}
    rows = []
    for x in names:
        rows += [(len(rows) + i, " ".join(rng.choices(own[x], k=40)), x, "s", 0) for i in range(12)]
    docs = spark.createDataFrame(rows, DOCUMENT)
    sample = language._sample(docs)
    kept = docs.where(~language.held_out(F.col("doc_id"))).count()
    assert len(sample) == kept and {x for x, _ in sample} == set(names)
    model = language.train(sample)
    found = language.label([r[1] for r in rows], language.Emitter(model))
    assert np.mean([f[0] == r[2] for f, r in zip(found, rows, strict=True)]) > 0.9


def test_the_sample_is_bounded_for_each_language(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE_DOCS", 5)
    docs = spark.createDataFrame([(i, "to mi", f"l{i % 3}", "s", 0) for i in range(200)], DOCUMENT)
    assert sorted(x for x, _ in language._sample(docs)) == ["l0"] * 5 + ["l1"] * 5 + ["l2"] * 5


def test_marginals_of_many_languages(monkeypatch):
    rng = np.random.default_rng(11)
    scores, moves = rng.normal(size=(200, 5)) * 3, rng.normal(size=(5, 5)) * 2
    first = np.arange(200) % 70 == 0
    blocks = language.marginals(scores, first, moves)
    monkeypatch.setattr(language, "FEW_LANGUAGES", 2)
    assert np.allclose(language.marginals(scores, first, moves), blocks)
