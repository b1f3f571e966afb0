"""Benchmark decontamination by pigeonhole edit matching.

An item of `m` characters may differ from its copy in a document by `k` edits, a
fixed share of `m`. It is cut into `k + 1` pieces; `k` edits cannot touch them all,
so a copy holds at least one piece unchanged. An Aho-Corasick automaton finds all
piece hits in one pass over a document, and Myers' bit-parallel distance verifies
the item around each hit. Within the budget no copy is missed.

The documents are read once per block of items and never shuffled. A block holds at
most BLOCK_CHARS characters, so what is broadcast has a fixed bound however many
items there are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from uuid import uuid4

import ahocorasick
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketweave.llm.common import filter_batches, held, map_batches

# Edits that are allowed, as a share of an item's normalised characters.
ERROR_RATE = 0.06
# An item with fewer normalised characters says nothing about where it comes from.
LEAST_CHARS = 8
# Characters of normalised items in one broadcast block.
BLOCK_CHARS = 2_000_000

_PLAIN = re.compile(r"[\W_]+")


def normalise(text: str | None) -> str:
    """Lower case, with runs of anything but letters and digits as one blank."""
    return _PLAIN.sub(" ", text.lower()).strip() if text else ""


def budget(length: int, error_rate: float = ERROR_RATE) -> int:
    return int(length * error_rate)


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """`item` in `k + 1` pieces of nearly equal length, each with its place."""
    cuts = [len(item) * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


class Pattern:
    """An item, ready for Myers' algorithm in both directions."""

    def __init__(self, text: str, k: int):
        self.text, self.k, self.size = text, k, len(text)
        self.forward, self.backward = self._masks(text), self._masks(text[::-1])

    @staticmethod
    def _masks(text: str) -> dict[str, int]:
        masks: dict[str, int] = {}
        for i, c in enumerate(text):
            masks[c] = masks.get(c, 0) | 1 << i
        return masks

    def _scores(self, masks: dict[str, int], text: str, anchored: bool) -> Iterator[int]:
        """The distance of the item to what ends at each character of `text`.

        Anchored, the match begins with `text`; else it may begin anywhere in it.
        """
        full, last = (1 << self.size) - 1, 1 << (self.size - 1)
        up, down, score = full, 0, self.size
        for c in text:
            same = masks.get(c, 0)
            vertical = same | down
            across = (((same & up) + up) & full ^ up) | same
            more = down | full & ~(across | up)
            less = up & across
            if more & last:
                score += 1
            elif less & last:
                score -= 1
            more = more << 1 & full | anchored
            less = less << 1 & full
            up = less | full & ~(vertical | more)
            down = more & vertical
            yield score

    def best(self, text: str, start: int, end: int) -> tuple[int, int, int] | None:
        """Distance, start and end of the closest match in ``text[start:end]``.

        The leftmost end wins among equal distances, then the shortest match.
        """
        low, at = self.k + 1, 0
        for i, score in enumerate(self._scores(self.forward, text[start:end], False)):
            if score < low:
                low, at = score, start + i + 1
        if low > self.k:
            return None
        reach = max(start, at - self.size - low)
        back = self._scores(self.backward, text[reach:at][::-1], True)
        for length, score in enumerate(back, 1):
            if score == low:
                return low, at - length, at
        return None


class Finder:
    """Finds the items of one block in texts."""

    def __init__(self, items: list[tuple[int, str]], error_rate: float):
        self.ids = [i for i, _ in items]
        self.patterns = [Pattern(t, budget(len(t), error_rate)) for _, t in items]
        found: dict[str, list[tuple[int, int]]] = {}
        for n, pattern in enumerate(self.patterns):
            for place, piece in pieces(pattern.text, pattern.k):
                found.setdefault(piece, []).append((n, place))
        self.automaton = ahocorasick.Automaton()
        for piece, uses in found.items():
            self.automaton.add_word(piece, (len(piece), uses))
        self.automaton.make_automaton()

    def matches(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        """Per item found: its id, distance, start and end in the normalised text."""
        text = normalise(text)
        starts: dict[int, list[int]] = {}
        for last, (size, uses) in self.automaton.iter(text):
            for n, place in uses:
                starts.setdefault(n, []).append(last + 1 - size - place)
        for n, found in starts.items():
            pattern, best = self.patterns[n], None
            if not pattern.k:
                whole = (s for s in sorted(found) if self._is_whole(text, s, s + pattern.size))
                if (start := next(whole, None)) is not None:
                    yield self.ids[n], 0, start, start + pattern.size
                continue
            for start, end in self._windows(sorted(found), pattern):
                hit = pattern.best(text, max(0, start), end)
                if hit and (best is None or hit[0] < best[0]):
                    best = hit
            if best:
                yield self.ids[n], *best

    @staticmethod
    def _is_whole(text: str, start: int, end: int) -> bool:
        """Whether a stretch begins and ends with a word of the text."""
        return text[start - 1 : start] in ("", " ") and text[end : end + 1] in ("", " ")

    @staticmethod
    def _windows(starts: list[int], pattern: Pattern) -> Iterator[tuple[int, int]]:
        """The stretches that the hits allow, overlapping ones as one."""
        k, reach = pattern.k, pattern.size + pattern.k
        low, high = starts[0] - k, starts[0] + reach
        for start in starts[1:]:
            if start - k > high:
                yield low, high
                low = start - k
            high = start + reach
        yield low, high


def _cached(key: str, items: list[tuple[int, str]], error_rate: float) -> Finder:
    """The finder of a block, kept by the worker for its next task."""
    return held("decontaminate", key, lambda: Finder(items, error_rate))


def _blocks(items: DataFrame, limit: int) -> Iterator[list[tuple[int, str]]]:
    """The normalised items in blocks; the driver holds one row more than a block."""
    block, size = [], 0
    rows = items.select("item_id", "text").where("item_id IS NOT NULL AND text IS NOT NULL")
    for row in rows.dropDuplicates().orderBy("item_id", "text").toLocalIterator():
        text = normalise(row["text"])
        if len(text) < LEAST_CHARS:
            continue
        if block and size + len(text) > limit:
            yield block
            block, size = [], 0
        block.append((row["item_id"], text))
        size += len(text)
    if block:
        yield block


def _finders(spark: SparkSession, items: DataFrame, error_rate: float, block_chars: int):
    """For each block of items what makes its finder in a task."""
    for block in _blocks(items, block_chars):
        shared, key = spark.sparkContext.broadcast(block), uuid4().hex
        yield lambda shared=shared, key=key: _cached(key, shared.value, error_rate)


def find_matches(
    docs: DataFrame,
    items: DataFrame,
    error_rate: float = ERROR_RATE,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """Which benchmark items each document holds, up to `error_rate` edits.

    `docs` has ``doc_id`` and ``text``, `items` ``item_id`` and ``text``; other columns
    are ignored. One row per document and item: ``doc_id``, ``item_id``, ``distance``,
    and ``start`` and ``end`` of the closest match in the normalised text (the leftmost
    end among equals). Rows of either table without text or letters, and items without
    an id, match nothing; a repeated row gives repeated matches, items that share an id
    count as one, by their closest text. An item too short for one edit must occur
    exactly, as whole words, and one of fewer than LEAST_CHARS normalised characters
    matches nothing. Empty tables give an empty frame.
    """
    schema = "doc_id bigint, item_id bigint, distance int, start int, end int"
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    found = []
    for finder_of in _finders(docs.sparkSession, items, error_rate, block_chars):

        def make(finder_of=finder_of):
            finder = finder_of()

            def step(ids, rows):
                hits = []
                for doc_id, text in zip(ids, rows, strict=True):
                    best: dict[int, tuple] = {}
                    for item_id, *hit in finder.matches(text):
                        best[item_id] = min(best.get(item_id, tuple(hit)), tuple(hit))
                    hits += [(doc_id, item_id, *hit) for item_id, hit in best.items()]
                names = ("doc_id", "item_id", "distance", "start", "end")
                return {name: [hit[i] for hit in hits] for i, name in enumerate(names)}

            return step

        found.append(map_batches(texts, make, schema))
    if not found:
        return docs.sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.unionAll, found)


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    error_rate: float = ERROR_RATE,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The rows of `docs` whose ``text`` holds no item; all columns stay.

    Each row is judged by its text alone, so null and repeated ids do no harm; a row
    without text stays.
    """
    for finder_of in _finders(docs.sparkSession, items, error_rate, block_chars):

        def make(finder_of=finder_of):
            finder = finder_of()
            return lambda texts: [next(finder.matches(t), None) is None for t in texts]

        docs = filter_batches(docs, ["text"], make)
    return docs
