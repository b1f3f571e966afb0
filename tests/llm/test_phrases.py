import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from basketweave.llm import phrases, sql
from tests.llm.conftest import documents, with_clashes

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_force(rows, top, longest=3, least=10):
    counts, words = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            found = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(found)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(found[i : i + k]) for i in range(len(found) - k + 1))
    out = []
    for lang, f in counts.items():
        picked = []
        for phrase, a in f.items():
            if len(phrase) < 2 or a < least:
                continue
            score, _, left, right = min(
                (10**6 * a * a // (f[phrase[:k]] * f[phrase[k:]]), k, f[phrase[:k]], f[phrase[k:]])
                for k in range(1, len(phrase))
            )
            inside = any(
                100 * n >= 50 * a
                and n >= least
                and len(other) > len(phrase)
                and any(other[i : i + len(phrase)] == phrase for i in range(len(other)))
                for other, n in f.items()
            )
            if not inside:
                picked.append((-score, -a, " ".join(phrase).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(picked)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, words[lang], -score))
    return sorted(out)


def found(df, ws, top=2000, **more):
    return sorted(tuple(r) for r in phrases.top_phrases(df, ws, top, **more).collect())


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(9)
    words = ["the", "of", "New", "york", "city", "Ünï", "ÉA", "a", "x\x00y", "big", "apple", "it's", "<s>"]
    weights = [9, 7, 3, 3, 2, 2, 1, 6, 1, 2, 2, 1, 1]
    out = []
    for _ in range(400):
        parts = rng.choices(words, weights, k=rng.randint(0, 40))
        out.append("".join(w + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r\n"]) for w in parts))
    return [*out, None, "", "New York City " * 30, "and so on " * 12, "one"]


def as_rows(spark, texts):
    langs = ["en", "de", None]
    frame = documents(spark, [(i // 2, t) for i, t in enumerate(texts)])
    lang = F.get(F.array(*[F.lit(x) for x in langs]), F.pmod(F.xxhash64("text"), F.lit(3)).cast("int"))
    return frame.withColumn("lang", lang).cache()


@pytest.mark.parametrize("longest", [2, 3, 4])
def test_agrees_with_brute_force(spark, ws, texts, longest):
    df = as_rows(spark, texts)
    rows = [(r["lang"], r["text"]) for r in df.collect()]
    want = brute_force(rows, 40, longest)
    assert len(want) > 30
    assert found(with_clashes(df), ws, 40, longest=longest) == want


def test_sql_agrees(spark, ws, texts):
    df = as_rows(spark, texts)
    con = duckdb.connect()
    con.register("documents", df.toArrow())
    assert sorted(con.sql(sql.phrases(2000)).fetchall()) == found(df, ws)


def test_common_words_and_small_buffers_change_nothing(spark, ws, texts, monkeypatch):
    df = as_rows(spark, texts)
    want = found(df, ws)
    monkeypatch.setattr(phrases, "COMMON", 1.0)
    assert found(df, ws) == want
    counts = phrases.phrase_counts(df, ws, buffer=50)
    assert counts.rows == phrases.phrase_counts(df, ws).rows
    assert sorted(map(str, counts.df.collect())) == sorted(map(str, phrases.phrase_counts(df, ws).df.collect()))


def test_tails_hold_every_window(spark, texts):
    df = as_rows(spark, texts)
    n = 0
    for row in phrases.windows(df, 3, {"the", "of"}).collect():
        for tail in row["tails"].split(","):
            words, _, count = tail.partition("\t")
            assert len(words.split(" ")) == 2
            n += int(count or 1)
        assert (row["piece"] > 0) == (row["w1"] in ("the", "of"))
    words = [re.findall(r"[^\s.,;:!?]+", t or "") for t in texts]
    assert n == sum(map(len, words))


def test_common_words(spark, texts):
    df = documents(spark, texts).repartition(3)
    words = Counter(w for t in texts for w in re.findall(r"[^\s.,;:!?]+", (t or "").translate(LOWER)))
    for share in (0.3, 0.1, 0.02):
        found = phrases.common_words(df, share, buffer=70)
        assert {w for w, n in words.items() if n >= share * words.total()} <= found
        assert len(found) <= 2 / share
    assert phrases.common_words(documents(spark, []), 0.1) == set()


def test_scores_are_exact_beyond_64_bits(spark):
    a, left, right = 3_000_000_007, 5_000_000_029, 7_000_000_001
    got = spark.range(1).select(*[F.lit(x).alias(n) for n, x in zip("alr", (a, left, right), strict=True)])
    assert got.select(phrases._score("a", "l", "r")).first()[0] == 10**6 * a * a // (left * right)


def test_overlaps_ties_and_absorbed_phrases(spark, ws):
    df = documents(spark, ["x x x x x x x x x x x x"] + ["p q"] * 10 + ["r s"] * 10)
    rows = found(df, ws)
    assert ("en", 1, "p q", 10, 10, 10, 52, 1_000_000) in rows
    assert ("en", 2, "r s", 10, 10, 10, 52, 1_000_000) in rows
    # "x x" stands 11 times but "x x x" 10 times, which absorbs it; its best cut is the first.
    assert [r for r in rows if r[2].startswith("x")] == [("en", 3, "x x x", 10, 12, 11, 52, 757_575)]


def test_one_very_long_text(spark, ws, texts):
    whole = "\n".join(t for t in texts if t)
    df = documents(spark, [whole * 20])
    assert found(df, ws, 30) == brute_force([("en", whole * 20)], 30)


def test_empty_tables(spark, ws):
    for rows in ([], [None, ""]):
        assert found(documents(spark, rows), ws) == []
