"""Edit matching against a plain dynamic programme."""

import random

import pytest

from basketweave.llm import decontaminate as dc
from tests.llm.conftest import documents, with_clashes


def closest(item, text):
    """The least distance of `item` to any stretch of `text`."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        last, row[0] = row[0], i
        for j, b in enumerate(text, 1):
            last, row[j] = row[j], min(last + (a != b), row[j] + 1, row[j - 1] + 1)
    return min(row)


def edited(rng, text, edits):
    chars = list(text)
    for _ in range(edits):
        at = rng.randrange(len(chars))
        rng.choice(
            [lambda: chars.pop(at), lambda: chars.insert(at, "q"), lambda: chars.__setitem__(at, "z")]
        )()
    return "".join(chars)


@pytest.fixture(scope="module")
def cases(vocabulary):
    rng = random.Random(1)

    def prose(n):
        return " ".join(rng.choices(vocabulary, k=n))

    items = [prose(rng.randint(12, 30)) for _ in range(8)]
    texts = [prose(60) for _ in range(6)]
    for item in items:
        k = dc.budget(len(item))
        for edits in (0, k // 2, k, 2 * k + 3):
            texts.append(f"{prose(20)} {edited(rng, item, edits)} {prose(20)}")
    return items, texts


@pytest.mark.parametrize("block_chars", [200, 1_000_000])
def test_agrees_with_brute_force(spark, cases, block_chars):
    items, texts = cases
    frame = spark.createDataFrame(list(enumerate(items)), "item_id BIGINT, text STRING")
    found = dc.find_matches(documents(spark, texts), frame, block_chars=block_chars)
    expected = {}
    for d, text in enumerate(texts):
        for i, item in enumerate(items):
            distance = closest(dc.normalise(item), dc.normalise(text))
            if distance <= dc.budget(len(dc.normalise(item))):
                expected[d, i] = distance
    rows = found.collect()
    assert {(r["doc_id"], r["item_id"]): r["distance"] for r in rows} == expected
    for r in rows:
        piece = dc.normalise(texts[r["doc_id"]])[r["start"] : r["end"]]
        assert closest(piece, dc.normalise(items[r["item_id"]])) <= r["distance"]
    assert len(expected) >= 16


def test_pieces_cover_the_item():
    for k in (0, 1, 4):
        parts = dc.pieces("abcdefghij", k)
        assert len(parts) == k + 1 and "".join(p for _, p in parts) == "abcdefghij"


def test_odd_rows(spark, cases):
    items, texts = cases
    rows = [(0, None), (1, ""), (2, "!!"), (None, items[0]), (3, items[0]), (3, items[0])]
    rows.append((4, "x " * 200_000 + items[1]))
    docs = with_clashes(documents(spark, rows))
    bench = spark.createDataFrame(
        [(0, items[0]), (1, items[1]), (1, items[1]), (2, None), (None, items[2]), (5, "--")],
        "item_id BIGINT, text STRING",
    )
    found = sorted(
        ((r["doc_id"], r["item_id"]) for r in dc.find_matches(docs, with_clashes(bench)).collect()),
        key=str,
    )
    assert found == [(3, 0), (3, 0), (4, 1), (None, 0)]
    kept = dc.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    assert [r["doc_id"] for r in kept.orderBy("doc_id").collect()] == [0, 1, 2]


def test_empty_tables(spark, cases):
    items, texts = cases
    docs, bench = documents(spark, texts), spark.createDataFrame([], "item_id BIGINT, text STRING")
    assert dc.find_matches(docs, bench).collect() == []
    assert dc.decontaminate(docs, bench).count() == len(texts)
    bench = spark.createDataFrame([(0, items[0])], "item_id BIGINT, text STRING")
    assert dc.find_matches(docs.limit(0), bench).collect() == []


def test_short_items_match_whole_words_only(spark):
    texts = ["yesterday was fine", "yes", "the red house", "the red houses", "a red house!", "xred house"]
    bench = spark.createDataFrame([(0, "yes"), (1, "a"), (2, "Red house")], "item_id BIGINT, text STRING")
    found = dc.find_matches(documents(spark, texts), bench).collect()
    assert sorted((r["doc_id"], r["item_id"], r["distance"], r["start"], r["end"]) for r in found) == [
        (2, 2, 0, 4, 13), (4, 2, 0, 2, 11),
    ]
    kept = dc.decontaminate(documents(spark, texts), bench).collect()
    assert sorted(r["doc_id"] for r in kept) == [0, 1, 3, 5]
