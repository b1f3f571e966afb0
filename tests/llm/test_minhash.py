"""Groups of near copies against all pairs of full sets."""

import random
from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from basketweave.llm import minhash
from tests.llm.conftest import documents, with_clashes


def shingle_set(text):
    found = text.encode().lower().split() if text else []
    size = min(5, len(found))
    return {tuple(found[i : i + size]) for i in range(len(found) - size + 1)} if found else set()


def groups(texts):
    """The smallest id that links reach, by all pairs."""
    sets = {i: shingle_set(t) for i, t in texts.items()}
    parent = {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in combinations(sorted(texts), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= 75 * len(x | y):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return {i: root(i) for i in texts}


def test_agrees_with_all_pairs(spark, vocabulary, ws):
    """Copies of one text with few and many edits, around the threshold."""
    rng = random.Random(2)
    texts = []
    for size, copies in ((120, 60), (40, 25), (9, 8), (5, 4), (3, 3), (1, 3)):
        base = rng.choices(vocabulary, k=size)
        for n in range(copies):
            words = list(base)
            for _ in range(n % 7 if size > 5 else 0):
                words[rng.randrange(size)] = rng.choice(vocabulary)
            texts.append(" ".join(words))
    passage = " ".join(rng.choices(vocabulary, k=50))
    texts += [f"{passage} {' '.join(rng.choices(vocabulary, k=n))}" for n in range(2, 40, 2)]
    rng.shuffle(texts)
    found = minhash.near_duplicates(documents(spark, texts), ws).collect()
    assert len(found) == len(texts)
    expected = groups(dict(enumerate(texts)))
    assert {r["doc_id"]: r["component_id"] for r in found} == expected
    assert all(r["n_shingles"] == len(shingle_set(texts[r["doc_id"]])) for r in found)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_links_between_members_that_are_no_hub(spark, ws):
    """A chain: each text is like the next, few are like the hub."""
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words[i : i + 200]) for i in range(0, 200, 20)]
    found = minhash.near_duplicates(documents(spark, texts), ws).collect()
    assert {r["component_id"] for r in found} == {0}


def test_pairs_outside_the_hub(spark, ws):
    """`_others` proposes every link between members of one bucket."""
    rng = random.Random(6)
    base = list(range(100))
    sets = {0: set(base)}
    for i in range(1, 60):
        own = set(rng.sample(range(1000, 1040), rng.randint(5, 25)))
        sets[i] = set(rng.sample(base, rng.randint(60, 100))) | own
    rows = []
    for i in range(1, 60):
        shared = len(sets[i] & sets[0])
        linked = 100 * shared >= 75 * len(sets[i] | sets[0])
        rows.append((0, i, len(sets[i]), 100, shared, 0 if linked else i))
    frame = spark.createDataFrame(
        rows, "hub BIGINT, id BIGINT, n BIGINT, hub_n BIGINT, shared INT, component BIGINT"
    )
    table = spark.createDataFrame(
        [(i, sorted(s)) for i, s in sets.items()], "id BIGINT, set ARRAY<BIGINT>"
    )
    found = {tuple(sorted((r["hub"], r["id"]))) for r in minhash._others(ws, frame, table).collect()}
    component = {r[1]: r[5] for r in rows}
    links = {
        (a, b)
        for a, b in combinations(range(1, 60), 2)
        if component[a] != component[b]
        and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    }
    assert links and links <= found


def test_components(spark, ws):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 140)] + [(200, i) for i in range(201, 260)]
    edges += [(rng.randrange(300, 330), rng.randrange(300, 330)) for _ in range(25)]
    rng.shuffle(edges)
    frame = spark.createDataFrame([(b, a) if rng.random() < 0.5 else (a, b) for a, b in edges], "a BIGINT, b BIGINT")
    found = {r["node"]: r["component"] for r in minhash.components(ws, frame).collect()}
    label = {n: n for e in edges for n in e if e[0] != e[1]}
    for _ in range(100):
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    assert found == label
    assert minhash.components(ws, frame.limit(0)).collect() == []


def test_signature_is_unbiased():
    """Minima and maxima agree about as often as the sets resemble each other."""
    rng = np.random.default_rng(0)
    x = rng.integers(0, 1 << 63, 4000, np.uint64)
    a, b = np.unique(x[:3000]), np.unique(x[1000:])
    same = []
    for odd in minhash._ODD:
        pa, pb = a * odd, b * odd
        same += [pa.min() == pb.min(), pa.max() == pb.max()]
    assert abs(np.mean(same) - 0.5) < 0.1


def test_odd_rows(spark, ws):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [
        (7, None), (8, ""), (9, " \n\t"), (None, "a b c d e f"), (None, None),
        (3, "A b c d e f"), (1, "a B c d e f"), (1, "a b c d e f"), (4, "é b c d e f"),
        (5, "É b c d e f"), (10, long), (11, long + " tail"), (12, "a b"), (13, "a  b"),
    ]
    docs = with_clashes(documents(spark, rows))
    found = minhash.near_duplicates(docs, ws).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"]), r["kept"]) for r in found) == sorted(
        [
            ("7", 0, "7", True), ("8", 0, "8", True), ("9", 0, "9", True),
            ("None", 2, "None", True), ("None", 0, "None", True), ("3", 2, "1", False),
            ("1", 2, "1", True), ("1", 2, "1", True), ("4", 2, "4", True), ("5", 2, "5", True),
            ("10", 59_996, "10", True), ("11", 59_997, "10", False), ("12", 1, "12", True),
            ("13", 1, "12", False),
        ]
    )
    kept = minhash.deduplicate(docs, ws)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 3
    empty = docs.limit(0)
    assert minhash.near_duplicates(empty, ws).collect() == []
    assert minhash.deduplicate(empty, ws).where(F.lit(True)).collect() == []


def test_an_id_on_several_texts(spark, ws, vocabulary):
    """Each text counts for itself: no link is lost, and no other text of the id is dropped."""
    rng = random.Random(11)
    x, y, z = (" ".join(rng.choices(vocabulary, k=40)) for _ in range(3))
    rows = [(2, x), (2, y), (5, y + " more"), (1, z), (7, z), (7, "quite another text of some words")]
    docs = documents(spark, rows)
    found = {(r["doc_id"], r["n_shingles"]): (r["component_id"], r["kept"]) for r in minhash.near_duplicates(docs, ws).collect()}
    assert found[5, 37] == (2, False) and found[2, 36] == (2, True)
    assert found[7, 36] == (1, False) and found[7, 2] == (7, True)
    kept = sorted((r["doc_id"], r["text"]) for r in minhash.deduplicate(docs, ws).collect())
    assert kept == sorted([(2, x), (2, y), (1, z), rows[-1]])


def pooled(n, vocabulary):
    """Texts of one common passage and 7 of 24 pooled ones; every tenth repeats another's."""
    rng = random.Random(5)
    pool = [" ".join(rng.choices(vocabulary, k=14)) for _ in range(25)]
    texts = []
    for i in range(n):
        picked = rng.sample(range(1, 25), 7) if i % 10 else picked[:6] + [rng.choice(range(1, 25))] if texts else [*range(1, 8)]
        texts.append(" ".join(pool[p] for p in (0, *sorted(picked))))
    return texts


def test_pooled_passages_do_not_meet_in_all_pairs(spark, ws, vocabulary, monkeypatch):
    pairs, others = [], minhash._others

    def counted(ws, *more):
        found = ws.write("others", others(ws, *more))
        pairs.append(found.rows)
        return found.df

    monkeypatch.setattr(minhash, "_others", counted)
    texts = pooled(300, vocabulary)
    found = minhash.near_duplicates(documents(spark, texts), ws).collect()
    expected = groups(dict(enumerate(texts)))
    assert {r["doc_id"]: r["component_id"] for r in found} == expected
    assert len(set(expected.values())) < 300 and pairs[0] < 300 * 299 / 2 / 20
