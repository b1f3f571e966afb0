"""Token files against the tokenizer itself."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from basketweave.llm import tokens
from basketweave.workspace import Workspace
from tests.llm.conftest import documents, with_clashes

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def expected(path, rows, end):
    tokenizer, start, out = Tokenizer.from_file(path), 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    return out


@pytest.mark.parametrize("path, words, end", [(WORDS, True, 1), (BYTES, False, 50256)])
def test_round_trip(spark, vocabulary, path, words, end):
    rng = random.Random(7)
    rows = [(i * 3, " ".join(rng.choices(vocabulary, k=rng.randint(0, 50)))) for i in range(300)]
    rows += [(1, None), (2, ""), (4, "Word. <|endoftext|> it's 12,5\n\tx"), (-5, "long " * 50_000)]
    rng.shuffle(rows)
    docs = with_clashes(documents(spark, rows)).repartition(7)
    files = tokens.write_token_files(docs, Workspace(spark), path, end, words=words)
    found = sorted(tokens.read_token_files(files, with_ids=True).collect(), key=lambda r: r["start"])
    assert [(r[0], r[1], r[2], r[3], list(r[4])) for r in found] == expected(path, rows, end)


def test_pieces_encode_as_the_library_does():
    """Random pieces of all kinds of characters, in a small cache."""
    rng = random.Random(8)
    letters = "abcXYZéÉßñÑİıŉſµªǅ'’.,!?;:-_0129<|>́  \x1c日本ΣςK"
    texts = [
        "".join(rng.choices(letters + " \n\t", k=rng.randint(0, 60))) for _ in range(2000)
    ] + ["<|ENDOFTEXT|> <|endoftext|> Don't DON'T don't'S", "Word word. WORD, word"]
    library, encoder = Tokenizer.from_file(WORDS), tokens.Encoder(WORDS, True)
    tokens.CACHE_PIECES, before = 500, tokens.CACHE_PIECES
    try:
        found = encoder.encode(texts)
    finally:
        tokens.CACHE_PIECES = before
    for text, data in zip(texts, found, strict=True):
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(data, "<u2").tolist() == ids, text


def test_odd_rows(spark):
    rows = [(None, "b"), (None, "a"), (3, "x y"), (3, "x y"), (3, "w")]
    docs = documents(spark, rows)
    files = tokens.write_token_files(docs, Workspace(spark), WORDS, 1, words=True)
    found = sorted(tokens.read_token_files(files).collect(), key=lambda r: r["start"])
    assert [tuple(r) for r in found] == [x[:4] for x in expected(WORDS, rows, 1)]
    empty = tokens.write_token_files(docs.limit(0), Workspace(spark), WORDS, 1)
    assert tokens.read_token_files(empty).collect() == []
