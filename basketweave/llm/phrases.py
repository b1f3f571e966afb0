"""Phrases whose words stand together more often than their parts would.

Only the longest windows are counted: the padded word column of a language beside its own
leads, so each word begins one window, which ends early where its piece of text ends.
Every shorter phrase is a prefix of windows, and ROLLUP sums the windows by successively
shorter prefixes, down to all words of the language.

A task sums the windows of its rows and passes on one row for each first word, which lists
the other words of its windows. Those of a common first word are dealt to several tasks by
the second word, or by all others where every word but the last is common. For the other
prefixes what meets in one task is final, and so a prefix below the threshold is cut by
its last word before the sums: only its first words are still wanted.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketweave.functions.joins import lookup_join
from basketweave.llm.common import map_arrow
from basketweave.workspace import Table, Workspace

# Words of a phrase, its least count, and what a longer phrase must keep of it to replace it.
LONGEST, LEAST, ABSORBED = 3, 10, 50
SCALE = 1_000_000
UNKNOWN = "und"
# Words with this share of all words are common: at most as many as its inverse.
COMMON = 1 / 256
# Tasks that share the windows of a common first word.
PIECES = 32
# Words that a task holds before it sums their windows.
BUFFER = 1 << 20
# A phrase in a broadcast table, besides its characters.
PHRASE_BYTES = 96

# Stands between pieces; a comma is never part of a word.
_PAD = b","
_CUTS = bytes.maketrans(b".,;:!?\x0b\x0c\r", b"\n" * 9)


def _language(lang: str = "lang") -> Column:
    return F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN))


def common_words(docs: DataFrame, share: float = COMMON, buffer: int = BUFFER) -> set[str]:
    """At most ``2 / share`` words, among them all that make up `share` of all words.

    A task names the words that make up half of that in a stretch of its words; where a
    word is rarer it loses less than half, so what is named of it is at least the rest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        size = 0

        def flush() -> pa.RecordBatch:
            named = [(w.decode(), n) for w, n in counts.items() if 2 * n >= share * size]
            words, n = zip((None, size), *named, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(n, pa.int64())], ["word", "n"])

        for batch in batches:
            for text in batch.column(0):
                words = _words(text.as_py()).split()
                counts.update(words)
                size += len(words) - counts.pop(_PAD, 0)
                if size >= buffer:
                    yield flush()
                    counts.clear()
                    size = 0
        yield flush()

    texts = docs.select(F.col("text").cast("string")).where("text <> ''")
    named = map_arrow(texts, run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    least = F.coalesce(F.max(F.when(F.col("word").isNull(), F.col("n"))).over(W.partitionBy()), F.lit(0)) * share / 2
    found = named.withColumn("least", least).where(F.col("word").isNotNull() & (F.col("n") >= F.col("least")))
    return {r["word"] for r in found.select("word").collect()}


def _words(text: str) -> bytes:
    """A text in lower case, pads between its pieces."""
    data = text.encode("utf-8", "surrogatepass").lower().translate(_CUTS)
    return data.replace(b"\n", b" , ")


class Windows:
    """Sums the windows of one language; `size` words are held at most, and a text."""

    def __init__(self, longest: int, common: frozenset[bytes]):
        self.longest, self.common = longest, common
        self.clear()

    def clear(self) -> None:
        self.codes: dict[bytes, int] = {_PAD: 0}
        self.parts: list[np.ndarray] = []

    def add(self, text: str) -> int:
        """Take the words of a text; gives their number, pads included."""
        words, codes = _words(text).split(), self.codes
        new = set(words).difference(codes)
        codes.update(zip(new, range(len(codes), len(codes) + len(new)), strict=True))
        self.parts.append(np.array([*map(codes.__getitem__, words), 0], np.int32))
        return len(words)

    def sums(self) -> tuple[pa.Array, np.ndarray, pa.Array]:
        """By first word and piece: the distinct windows as texts of the other words.

        A tab and the count follow, unless that is one; commas part the windows.
        """
        column = np.concatenate([*self.parts, np.zeros(self.longest, np.int32)])
        leads = [column[i : len(column) - self.longest + i] for i in range(self.longest)]
        leads = [lead[leads[0] > 0] for lead in leads]
        for i in range(1, self.longest):  # a window ends at its first pad
            leads[i] = np.where(leads[i - 1] > 0, leads[i], 0)
        words = list(self.codes)
        common = np.array([w in self.common for w in words])
        hashed = np.array([zlib.crc32(w) % PIECES for w in words], np.int32)
        every = reduce(np.logical_and, (common[lead] for lead in leads[:-1]))
        second, mixed = hashed[leads[1]], sum(hashed[lead] for lead in leads[1:]) % PIECES
        piece = np.where(common[leads[0]], np.where(every, 1 + PIECES + mixed, 1 + second), 0)

        order = np.lexsort([*leads[:0:-1], piece, leads[0]])
        leads, piece = [lead[order] for lead in leads], piece[order]
        starts = np.flatnonzero(_changes([piece, *leads]))
        counts = np.diff(np.append(starts, len(order)))
        leads, piece = [lead[starts] for lead in leads], piece[starts]
        spelt = pa.array([b"", *words[1:]], pa.binary()).cast(pa.string())
        shown = pc.if_else(counts == 1, "", pc.binary_join_element_wise("", pa.array(counts).cast(pa.string()), "\t"))
        tails = [spelt.take(pa.array(lead)) for lead in leads[1:]]
        tails[-1] = pc.binary_join_element_wise(tails[-1], shown, "")
        tails = pc.binary_join_element_wise(*tails, " ")
        groups = np.flatnonzero(_changes([piece, leads[0]]))
        lists = pa.ListArray.from_arrays(np.append(groups, len(starts)).astype(np.int32), tails)
        return spelt.take(pa.array(leads[0][groups])), piece[groups], pc.binary_join(lists, ",")


def _changes(columns: list[np.ndarray]) -> np.ndarray:
    """Where a row differs from the one before, the first row included."""
    found = np.ones(len(columns[0]), bool)
    if len(found):
        found[1:] = reduce(np.logical_or, (c[1:] != c[:-1] for c in columns))
    return found


def _names(n: int) -> list[str]:
    return [f"w{i}" for i in range(1, n + 1)]


def windows(docs: DataFrame, longest: int, common: set[str], buffer: int = BUFFER) -> DataFrame:
    """The padded windows of `longest` words, summed in part: ``(lang, w1, piece, tails)``."""
    hot = frozenset(w.encode("utf-8", "surrogatepass") for w in common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Windows] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, of in held.items():
                firsts, piece, tails = of.sums()
                langs = pa.array([lang] * len(firsts), pa.string())
                whole = pa.RecordBatch.from_arrays(
                    [langs, firsts, pa.array(piece, pa.int32()), tails],
                    names=["lang", "w1", "piece", "tails"],
                )
                for at in range(0, len(firsts), 1 << 12):
                    yield whole.slice(at, 1 << 12)
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1), strict=True):
                lang = lang.as_py()
                if lang not in held:
                    held[lang] = Windows(longest, hot)
                size += held[lang].add(text.as_py())
                if size >= buffer:
                    yield from flush()
                    size = 0
        yield from flush()

    texts = docs.select(_language().alias("lang"), F.col("text").cast("string")).where("text <> ''")
    return map_arrow(texts, run, "lang string, w1 string, piece int, tails string")


def phrase_counts(
    docs: DataFrame, ws: Workspace, longest: int = LONGEST, least: int = LEAST, buffer: int = BUFFER
) -> Table:
    """Every phrase of up to `longest` words that stands `least` times in a language.

    ``(lang, phrase ARRAY<STRING>, f)``; the empty phrase has the number of all words,
    whatever it is. `docs` need ``lang`` and ``text``; observes the `bytes` of the phrases.
    """
    names = _names(longest)
    *firsts, last = names
    words = F.substring_index("tail", "\t", 1)
    count = F.substring_index("tail", "\t", -1).cast("bigint")
    others = [F.substring_index(F.substring_index(words, " ", i), " ", -1) for i in range(1, longest)]
    dealt = (
        windows(docs, longest, common_words(docs), buffer)
        .repartition("lang", "w1", "piece")
        .select("lang", "w1", "piece", F.explode(F.split("tails", ",")).alias("tail"))
        .select(
            "lang",
            "w1",
            *[w.alias(n) for w, n in zip(others, names[1:], strict=True)],
            "piece",
            F.when(F.contains("tail", F.lit("\t")), count).otherwise(1).alias("n"),
        )
    )
    longer = (
        dealt.groupBy("lang", *firsts, "piece", last)
        .agg(F.sum("n").alias("f"))
        .where((F.col("f") >= least) & (F.col(last) != ""))
        .select("lang", F.array(*names).alias("phrase"), "f")
    )
    # All windows of a prefix are in one task, unless it is of common words.
    prefixes = dealt.groupBy("lang", *firsts, "piece").agg(F.sum("n").alias("f"))
    hopeless = (F.col("f") < least) & (F.col("piece") <= PIECES)
    end = [F.when(hopeless, "").otherwise(F.col(n)).alias(n) for n in firsts[1:][-1:]]
    sums = (
        prefixes.select("lang", *firsts[: len(firsts) - len(end)], *end, "f")
        .rollup("lang", *firsts)
        .agg(F.sum("f").alias("f"))
        .select("lang", F.array_compact(F.array(*firsts)).alias("phrase"), "f")
    )
    # The words before a pad are a shorter prefix, which has a row of its own.
    shorter = sums.where(
        F.col("lang").isNotNull()
        & ~F.array_contains("phrase", "")
        & ((F.col("f") >= least) | (F.size("phrase") == 0))
    )
    return ws.write(
        "phrases",
        shorter.unionAll(longer),
        bytes=F.sum(F.octet_length(F.array_join("phrase", " "))),
    )


def _score(a: str, left: str, right: str) -> Column:
    """``floor(SCALE a² / (l r))``, exact beyond 64 bits; l and r are at least a."""
    wide = [F.col(c).cast("decimal(15,0)") for c in (a, a, left, right)]
    above = wide[0] * wide[1] * F.lit(SCALE).cast("decimal(7,0)")
    return F.call_function("div", above, wide[2] * wide[3])


def scored_phrases(counts: Table, ws: Workspace, absorbed: int = ABSORBED) -> DataFrame:
    """The candidates among `phrase_counts` with their best cut, absorbed ones left out.

    ``(lang, phrase, a, l, r, n, score)``, the phrase as text. A cut after the first k
    words scores ``floor(1000000 a² / (l r))``, and the least score counts, the smallest k
    among equal ones. A phrase whose words lie inside a longer one goes if that stands
    `absorbed` in a hundred times as often or more.
    """
    texts = counts.df.select("lang", F.array_join("phrase", " ").alias("text"), "f")
    width = PHRASE_BYTES + counts.stats["bytes"] // max(counts.rows, 1)
    found = counts.df.where(F.size("phrase") > 1)
    cuts = found.select(
        "lang", "phrase", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.size("phrase") - 1)).alias("k")
    )
    cuts = cuts.select(
        "*",
        F.concat_ws("\0", "lang", F.array_join(F.slice("phrase", F.lit(1), F.col("k")), " ")).alias("left"),
        F.concat_ws("\0", "lang", F.array_join(F.expr("slice(phrase, k + 1, size(phrase))"), " ")).alias("right"),
    )
    for side in ("left", "right"):
        of = texts.select(F.concat_ws("\0", "lang", "text").alias(side), F.col("f").alias(side[0]))
        cuts = lookup_join(cuts, of, side, counts.rows, width, ["phrase", "k"])
    best = (
        cuts.withColumn("score", _score("a", "l", "r"))
        .groupBy("lang", "phrase")
        .agg(F.min_by(F.struct("a", "l", "r", "score"), F.struct("score", "k")).alias("cut"))
    )
    inner = F.expr(
        "flatten(transform(sequence(2, size(phrase) - 1), m -> "
        "transform(sequence(1, size(phrase) - m + 1), i -> slice(phrase, i, m))))"
    )
    longer = (
        found.where(F.size("phrase") > 2)
        .select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), "f")
        .groupBy("lang", "phrase")
        .agg(F.max("f").alias("longer"))
    )
    kept = best.join(longer, ["lang", "phrase"], "left").where(
        F.coalesce(100 * F.col("longer") < absorbed * F.col("cut.a"), F.lit(True))
    )
    words = texts.where("text = ''").select("lang", F.col("f").alias("n"))
    return kept.join(words, "lang").select(
        "lang", F.array_join("phrase", " ").alias("phrase"), "cut.a", "cut.l", "cut.r", "n", "cut.score"
    )


def top_phrases(
    docs: DataFrame, ws: Workspace, top: int, longest: int = LONGEST, least: int = LEAST
) -> DataFrame:
    """Each language's first `top` phrases by score, then count, then bytes.

    ``(lang, rank, phrase, a, l, r, n, score)``. A null or empty text has no words, a null
    language is UNKNOWN, and a language without candidates has no row. Repeated rows count
    as often as they stand there; other columns are ignored.
    """
    scored = scored_phrases(phrase_counts(docs, ws, longest, least), ws)
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order).cast("bigint"))
    return ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
