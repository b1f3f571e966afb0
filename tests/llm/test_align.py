import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from basketweave.llm import align, queries
from tests.llm.conftest import documents, with_clashes

FIRST, SECOND = (public_tokenizers.path(n) for n in (queries.FIRST, queries.SECOND))


def spans(text):
    """Ids with the offsets where their bytes begin and end, read token by token."""
    out = []
    for path in (FIRST, SECOND):
        side = align.reader(path)
        ids = side.encode([text])[0]
        at, found = 0, []
        for i in ids:
            found.append((i, at, at + len(side.pieces[i])))
            at = found[-1][2]
        whole = b"".join(side.pieces[i] for i in ids)
        out.append(found if text and whole == b" " + text.encode() else None)
    return out if None not in out else ([], [])


def brute_force(texts):
    """Every figure of the query by comparing all tokens with all tokens."""
    rows, counts = [], Counter()
    for text in texts:
        a, b = spans(text or "")
        ends = [x[2] for x in a if x[2] in {y[2] for y in b}]
        groups, low = [], 0
        for end in ends:
            sides = [",".join(str(i) for i, s, e in side if low <= s and e <= end) for side in (a, b)]
            groups.append("|".join(sides))
            low = end
        links = [(x[0], y[0]) for x in a for y in b if x[2] == y[2]]
        counts.update(links)
        rows.append((len(a), len(b), ";".join(groups), links))
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return [
        {
            "n_a": n_a, "n_b": n_b, "n_groups": len(groups.split(";")) if groups else 0,
            "n_links": len(links), "n_best": sum(counts[x] == most[x[1]] for x in links),
            "count_sum": sum(counts[x] for x in links),
            "groups_sha256": hashlib.sha256(groups.encode()).hexdigest() if groups else "",
        }
        for n_a, n_b, groups, links in rows
    ]


def run(spark, df, ws):
    aligned = align.align(df, FIRST, SECOND)
    groups = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    rated = align.rate_links(aligned.withColumn("groups", groups), align.vocabulary(SECOND), ws)
    return rated.withColumnRenamed("groups", "groups_sha256")


TEXTS = [
    "Hello world, this is a plain text.", "Hello world, this is a plain text.", None, "", " ",
    "  two  blanks\tand\n\nlines ", "<|endoftext|> </s> <s> are plain text", "Größe ñandú 漢字 🙂🙂  x",
    "a" * 700, "▁ marked ▁▁text", "tail blank ", "x\x00y", "▁", "don't stop 12345 67.89",
]


@pytest.fixture(scope="module")
def noise():
    rng = random.Random(3)
    words = ["the", "quality", "über", "naïve", "x", "1999", "foo_bar", "hm...", "東京", "thing-ing"]
    return [" ".join(rng.choices(words, k=rng.randint(1, 60))) for _ in range(40)]


def test_agrees_with_brute_force(spark, ws, noise):
    texts = TEXTS + noise
    rows = run(spark, with_clashes(documents(spark, texts)), ws).orderBy("doc_id").collect()
    for row, want in zip(rows, brute_force(texts), strict=True):
        assert {k: row[k] for k in want} == want, texts[row["doc_id"]]
    assert sum(r["n_a"] > 0 for r in rows) >= len(texts) - 5


def test_windows_align_as_whole_texts_do(noise, monkeypatch):
    """Through distinct windows, through all windows where a hash is shared, and at once."""
    aligner = align.Aligner(FIRST, SECOND)
    tokens = aligner.tokens([*noise, "", "x" * 50])
    found = aligner.align(tokens)
    for t, text, n in zip(tokens, found.texts.to_pylist(), found.groups, strict=True):
        if t[0]:
            whole = aligner.groups([np.array(i) for i in t], [np.array([len(i)]) for i in t])
            assert whole.texts.to_pylist() == [text + ";"] and whole.groups.tolist() == [n]
    monkeypatch.setattr(align, "_MIXERS", align._MIXERS * np.uint64(0))
    again = aligner.align(tokens)
    assert again.texts.equals(found.texts) and again.links.tolist() == found.links.tolist()


def test_equal_windows_are_aligned_once(monkeypatch):
    aligner, asked = align.Aligner(FIRST, SECOND), []
    groups = align.Aligner.groups
    monkeypatch.setattr(
        align.Aligner, "groups", lambda self, ids, sizes: asked.append(len(sizes[0])) or groups(self, ids, sizes)
    )
    aligner.align(aligner.tokens(["word another " * 50, "another word " * 30]))
    assert asked[0] <= 6


def test_ranks_give_the_ids_of_the_file(noise):
    """The faster encoder against the library, on odd, random and overlong texts."""
    from tokenizers import Tokenizer

    side = align.ByteLevel(FIRST)
    assert side._ranks
    rng = random.Random(8)
    letters = "aZé漢🙂 '  \t\n\r\u00a0\u2003x09.,'s'll<|>-_\x00\x85\u3000Ⅷ½ǅ"
    texts = ["".join(rng.choices(letters, k=rng.randint(1, 80))) for _ in range(800)]
    texts += [t or "" for t in TEXTS] + noise + ["a" * 100_000, " " * 50_000 + "x", "\n" * 30_000, "ab" * 40_000]
    library = Tokenizer.from_file(FIRST)
    library.encode_special_tokens = True
    want = [x.ids for x in library.encode_batch([" " + t for t in texts], add_special_tokens=False)]
    assert side.encode(texts) == want
    side._ranks = None
    assert side.encode(texts) == want


def test_special_strings_are_plain_text():
    aligner = align.Aligner(FIRST, SECOND)
    (a, b), = aligner.tokens(["<|endoftext|> <s>"])
    assert a and b and 50256 not in a and 1 not in b


def test_long_text_and_links_past_the_broadcast(spark, ws, noise, monkeypatch):
    texts = [" ".join(noise * 40), *noise]
    whole = run(spark, documents(spark, texts), ws).orderBy("doc_id").collect()
    monkeypatch.setattr(align, "COUNT_BYTES", 1 << 40)
    monkeypatch.setattr(align, "BATCH_CHARS", 500)
    assert run(spark, documents(spark, texts), ws).orderBy("doc_id").collect() == whole
    assert whole[0]["n_a"] > 30_000


def test_ids_may_be_null_or_repeated(spark, ws):
    rows = run(spark, documents(spark, [(1, "one two"), (1, "three"), (None, "one two"), (1, "one two")]), ws)
    found = sorted((r["n_links"], r["count_sum"]) for r in rows.collect())
    assert found == [(1, 1), (2, 6), (2, 6), (2, 6)]


def test_empty_table(spark, ws):
    found = run(spark, documents(spark, []), ws)
    assert found.collect() == [] and "count_sum" in found.columns
