"""Which tokens of two tokenizers cover the same bytes.

Every text is tokenised whole by both. Where the next token of both begins with a space
and both have covered the same bytes, an anchor cuts the text; between two anchors lies a
window, mostly a word, as a tuple of ids on either side. What a window's groups and links
are depends on its ids only: the windows of a batch of texts are looked up by a hash of
their ids, compared with the first window of that hash, and each distinct pair of tuples
is aligned once.

A group is a stretch between two byte offsets at which tokens of both end and none lies
between; a link joins two tokens that end at one offset. How often two ids are linked is
counted over the whole corpus, and tells how well a link fits.
"""

from __future__ import annotations

import json
import os
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketweave.functions.joins import lookup_join
from basketweave.llm.common import held, map_batches
from basketweave.llm.tokens import Letters
from basketweave.workspace import Workspace

# Characters of the texts that are aligned together; a longer one is by itself.
BATCH_CHARS = 1 << 20
# A broadcast row of counts.
COUNT_BYTES = 48

_MIXERS = np.random.default_rng(12).integers(1, 1 << 63, 3, np.uint64) * np.uint64(2) + np.uint64(1)


# How byte-level tokenizers part a text if they use their built-in pattern.
PARTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class ByteLevel:
    """A file of the tokenizers library with a byte-level alphabet.

    If the file merges in the order of its ids and uses the built-in pattern without any
    normaliser, as is checked, its ids are ranks. A faster library then gives the same
    ids; a text that is too much for its pattern goes through the file's own.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has the cores
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        byte_of = Letters().bytes()
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=True)
        self.pieces = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            known = all(c in byte_of for c in token)
            self.pieces[i] = bytes(byte_of[c] for c in token) if known else token.encode()
        self._ranks = self._ranked(json.loads(self._tokenizer.to_str()))

    def _ranked(self, file: dict):
        """The encoder by ranks, if the file allows it."""
        import tiktoken

        model, parts, vocabulary = file["model"], file["pre_tokenizer"] or {}, file["model"]["vocab"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model.get("merges", [])]
        made = [vocabulary.get("".join(m)) for m in merges]
        plain = (
            model["type"] == "BPE"
            and file["normalizer"] is None
            and parts.get("type") == "ByteLevel"
            and parts.get("use_regex", True)
            and not parts.get("add_prefix_space")
            and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix"))
            and None not in made
            and made == sorted(set(made))
            and {i for i in vocabulary.values() if len(self.pieces[i]) > 1} >= set(made)
            and all(t["special"] for t in file["added_tokens"])
        )
        if not plain:
            return None
        single = {self.pieces[i]: i for i in vocabulary.values() if len(self.pieces[i]) == 1}
        ranks = single | {self.pieces[i]: i for i in made}
        if len(single) != 256 or len(ranks) != 256 + len(made):
            return None
        return tiktoken.Encoding("file", pat_str=PARTS, mergeable_ranks=ranks, special_tokens={})

    def _one(self, text: str) -> list[int]:
        try:
            return self._ranks.encode_ordinary(text)
        except BaseException as error:  # a panic is no Exception
            if isinstance(error, (KeyboardInterrupt, SystemExit)):
                raise
            return self._tokenizer.encode(text, add_special_tokens=False).ids

    def encode(self, texts: list[str]) -> list[list[int]]:
        spaced = [" " + t for t in texts]
        if self._ranks:
            return [self._one(t) for t in spaced]
        return [x.ids for x in self._tokenizer.encode_batch_fast(spaced, add_special_tokens=False)]


class Pieces:
    """A sentencepiece model, which puts the space before a text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = [self._bytes(i) for i in range(self._model.get_piece_size())]

    def _bytes(self, i: int) -> bytes:
        piece = self._model.id_to_piece(i)
        if self._model.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self._model.encode(texts, num_threads=1)


def reader(path: str) -> ByteLevel | Pieces:
    """The tokenizer in a ``.json`` or ``.model`` file."""
    return Pieces(path) if path.endswith(".model") else ByteLevel(path)


def vocabulary(path: str) -> int:
    """The number of ids of the tokenizer in a file."""
    return len(reader(path).pieces)


@dataclass(frozen=True)
class Aligned:
    """Aligned stretches, one after another: how many groups and links, and these."""

    groups: np.ndarray
    texts: pa.Array  # each group of a stretch, ended by a semicolon
    links: np.ndarray


def _starts(sizes: np.ndarray) -> np.ndarray:
    """Where stretches of these sizes begin, and where the last one ends."""
    return np.concatenate(([0], np.cumsum(sizes)))


def _members(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all members of stretches that begin and are as long as given."""
    ends = _starts(sizes)
    return np.arange(ends[-1]) + np.repeat(starts - ends[:-1], sizes)


def _joined(texts: pa.Array, sizes: np.ndarray) -> pa.Array:
    """Neighbouring texts as one, so many at a time."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: len(texts) + 1]
    kept = pa.py_buffer(np.ascontiguousarray(offsets[_starts(sizes)]))
    return pa.LargeStringArray.from_buffers(len(sizes), kept, texts.buffers()[2])


class Aligner:
    """Aligns the ids of two tokenizers. Every token has a byte at least."""

    def __init__(self, first: str, second: str):
        self.sides = reader(first), reader(second)
        self.size = len(self.sides[1].pieces)
        self.pairs = len(self.sides[0].pieces) * self.size
        self._lengths = [np.array([len(p) for p in s.pieces], np.int64) for s in self.sides]
        self._spaced = [np.array([p[:1] == b" " for p in s.pieces]) for s in self.sides]
        # An id with what follows it: another one of its side, or the end of it.
        self._shown = [
            pa.array([f"{i}{mark}" for i in range(len(s.pieces)) for mark in (",", end)])
            for s, end in zip(self.sides, "|;", strict=True)
        ]

    def tokens(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        """The ids of both per text; none where either does not give back the bytes."""
        out = []
        for text, *ids in zip(texts, *(s.encode(texts) for s in self.sides), strict=True):
            whole = b" " + text.encode()
            same = text and all(
                b"".join(map(side.pieces.__getitem__, found)) == whole
                for side, found in zip(self.sides, ids, strict=True)
            )
            out.append(tuple(ids) if same else ([], []))
        return out

    def groups(self, ids: list[np.ndarray], sizes: list[np.ndarray]) -> Aligned:
        """Align stretches of so many ids each, over the same bytes."""
        ends = [np.cumsum(n[i]) for n, i in zip(self._lengths, ids, strict=True)]
        common = np.intersect1d(*ends, assume_unique=True)
        last = [np.searchsorted(e, common) for e in ends]
        links = ids[0][last[0]] * self.size + ids[1][last[1]]
        stretch = np.searchsorted(_starts(sizes[0])[1:], last[0], "right")
        counts = np.bincount(stretch, minlength=len(sizes[0]))
        # The texts of all ids in the order of their groups, the first side before the second.
        shown, order = [], []
        for side, (i, e, at) in enumerate(zip(ids, ends, last, strict=True)):
            ended = np.zeros(len(i), np.int64)
            ended[at] = 1
            shown.append(self._shown[side].take(pa.array(2 * i + ended)))
            order.append(2 * np.searchsorted(common, e) + side)
        keys = np.concatenate(order)
        texts = pa.concat_arrays(shown).take(pa.array(np.argsort(keys, kind="stable")))
        return Aligned(counts, _joined(texts, sizes[0] + sizes[1]), links)

    def _windows(self, ids: list[np.ndarray]) -> list[np.ndarray]:
        """How many ids of each side the windows between anchors have."""
        ends = [np.cumsum(n[i]) for n, i in zip(self._lengths, ids, strict=True)]
        marked = [
            e[np.append(spaced[i[1:]], True)] for e, i, spaced in zip(ends, ids, self._spaced, strict=True)
        ]
        anchors = np.intersect1d(*marked, assume_unique=True)
        return [np.diff(np.searchsorted(e, anchors, "right"), prepend=0) for e in ends]

    @staticmethod
    def _distinct(ids: list[np.ndarray], sizes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The first of each kind of window, and the kind of every window."""
        key = np.zeros(len(sizes[0]), np.uint64)
        starts = [_starts(n)[:-1] for n in sizes]
        for i, n, at, odd in zip(ids, sizes, starts, _MIXERS, strict=False):
            place = (np.arange(len(i)) - np.repeat(at, n)).astype(np.uint64)
            mixed = (i.astype(np.uint64) + np.uint64(1)) * odd
            mixed = (mixed ^ (mixed >> np.uint64(29))) * (place * _MIXERS[2] | np.uint64(1))
            key = key * odd + np.add.reduceat(mixed ^ (mixed >> np.uint64(32)), at)
        _, first, kind = np.unique(key, return_index=True, return_inverse=True)
        of = first[kind]
        same = all(np.array_equal(n[of], n) for n in sizes) and all(
            np.array_equal(i[_members(at[of], n)], i) for i, at, n in zip(ids, starts, sizes, strict=True)
        )
        # Windows that share a hash only are not told apart by it; then each stands alone.
        every = np.arange(len(key))
        return (first, kind) if same else (every, every)

    def align(self, tokens: list[tuple[list[int], list[int]]]) -> Aligned:
        """The groups of texts, from the ids of both sides of each."""
        ids = [np.concatenate([np.empty(0, np.int64), *(t[side] for t in tokens)]).astype(np.int64) for side in (0, 1)]
        per_text = [np.array([len(t[side]) for t in tokens], np.int64) for side in (0, 1)]
        if not len(ids[0]):
            return Aligned(np.zeros(len(tokens), np.int64), pa.array([""] * len(tokens)), np.empty(0, np.int64))
        sizes = self._windows(ids)
        first, kind = self._distinct(ids, sizes)
        known = self.groups(
            [i[_members(_starts(n)[first], n[first])] for i, n in zip(ids, sizes, strict=True)],
            [n[first] for n in sizes],
        )
        # The alignments of the kinds, window by window, then text by text.
        groups = known.groups[kind]
        links = known.links[_members(_starts(known.groups)[kind], groups)]
        cuts = np.searchsorted(_starts(sizes[0]), _starts(per_text[0]))
        texts = _joined(known.texts.take(pa.array(kind)), np.diff(cuts))
        return Aligned(np.diff(_starts(groups)[cuts]), pc.utf8_slice_codeunits(texts, 0, -1), links)

    def counted(self, aligned: Aligned) -> tuple[pa.Array, pa.Array]:
        """The distinct links of each text and how often it has them, as lists."""
        text = np.repeat(np.arange(len(aligned.groups)), aligned.groups)
        found, times = np.unique(text * self.pairs + aligned.links, return_counts=True)
        cuts = np.searchsorted(found, np.arange(len(aligned.groups) + 1) * self.pairs).astype(np.int32)
        return tuple(pa.ListArray.from_arrays(cuts, pa.array(x)) for x in (found % self.pairs, times))


def _batches(texts: list[str]):
    """Where batches of about BATCH_CHARS begin and end."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > BATCH_CHARS:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def align(docs: DataFrame, first: str, second: str) -> DataFrame:
    """The alignment of every text under the tokenizers in the files `first`, `second`.

    ``doc_id``, ``n_a``, ``n_b`` (tokens), ``n_groups``, ``n_links``, ``groups`` (as
    ``a1,a2|b1;a3|b2``, ids in order), and the distinct links as ``pairs`` (the first id
    times the size of the second vocabulary, plus the second id) with their ``times``. A
    text that is null, empty or not given back byte by byte by both has no tokens, so
    zeros, an empty text and empty lists. One row per row of `docs`, repeated ids and
    null ids included; other columns are ignored.
    """

    def make():
        aligner = held("align", (first, second), lambda: Aligner(first, second))

        def step(ids, texts):
            names = ("n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times")
            out = {n: [] for n in names}
            texts = [t or "" for t in texts]
            for start, end in _batches(texts):
                tokens = aligner.tokens(texts[start:end])
                found = aligner.align(tokens)
                sizes = [pa.array([len(t[side]) for t in tokens], pa.int64()) for side in (0, 1)]
                groups = pa.array(found.groups, pa.int64())
                columns = (*sizes, groups, groups, found.texts.cast(pa.string()), *aligner.counted(found))
                for name, column in zip(names, columns, strict=True):
                    out[name].append(column)
            return {"doc_id": ids} | {n: pa.concat_arrays(c) for n, c in out.items()}

        return step

    schema = (
        "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
        "groups string, pairs array<bigint>, times array<bigint>"
    )
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return map_batches(texts, make, schema)


def link_counts(aligned: DataFrame, vocabulary: int) -> DataFrame:
    """How often each pair is linked: ``(pair, count, best)``.

    `best` is whether no other first id is linked to the second id more often. There are
    at most as many rows as pairs of ids that ever end together. `vocabulary` is the size
    of the second vocabulary.
    """
    linked = F.explode(F.arrays_zip("pairs", "times")).alias("link")
    counts = (
        aligned.select(linked)
        .groupBy(F.col("link.pairs").alias("pair"))
        .agg(F.sum("link.times").alias("count"))
        .withColumn("second", F.col("pair") % vocabulary)
    )
    most = counts.groupBy("second").agg(F.max("count").alias("most"))
    return counts.join(most, "second").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def rate_links(aligned: DataFrame, vocabulary: int, ws: Workspace) -> DataFrame:
    """`aligned` with what the counts of the whole corpus say about its links.

    Adds ``n_best``, links whose pair is the most frequent of its second id, ties
    included, and ``count_sum``, the counts of all links summed. ``pairs`` and ``times``
    go. Rows are told apart by a number of their own, so ids may be null or repeated.
    """
    kept = [c for c in aligned.columns if c not in ("pairs", "times")]
    table = ws.write("aligned", aligned.withColumn("_row", F.monotonically_increasing_id()))
    counts = ws.write("link_counts", link_counts(table.df, vocabulary))
    links = table.df.select("_row", F.explode(F.arrays_zip("pairs", "times")).alias("link")).select(
        "_row", F.col("link.pairs").alias("pair"), F.col("link.times").alias("times")
    )
    rated = (
        lookup_join(links, counts.df, "pair", counts.rows, COUNT_BYTES, ["_row"])
        .groupBy("_row")
        .agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("times") * F.col("count")).alias("count_sum"),
        )
    )
    none = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("n_best", "count_sum")]
    return table.df.join(rated, "_row", "left").select(*kept, *none)
