"""Language of texts by a linear-chain conditional random field over words.

Each word has features of its ends, its character n-grams and its membership in
lexicons; each pair of neighbouring words has a learned transition. Training sequences
are stitched from stretches of several languages, so the model learns how languages
switch within a text. Forward-backward gives every word's probabilities; their mean
over a text decides.

The model is fitted on a sample of labelled documents with documented bounds. All texts
are labelled whole, batch by batch, with no shuffle. Within a batch the chain is cut into
blocks whose transfer matrices are multiplied first, which is exact and lets all
blocks advance at once.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from uuid import uuid4
from zlib import crc32

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketweave.llm.common import held, map_batches

# Languages are learned where the CRC of the document's id, modulo FOLDS, is not HELD_OUT.
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"
# The sample: documents of each language, by a hash of their ids, and the characters of
# all of them, whose texts are taken whole; a longer text is not drawn.
SAMPLE_DOCS, SAMPLE_CHARS = 300, 400_000
# Words in a language's lexicon.
LEXICON_WORDS = 300
# Features are hashed to so many weights per language.
BUCKETS = 1 << 17
# Training sequences: their words, how many at once, passes, step size and shrinkage.
LENGTH, BATCH, PASSES, RATE, SHRINK = 48, 48, 4, 0.25, 1e-6
# Words of one stretch in a training sequence, on average.
STRETCH = 16
# Words that are labelled together, and in one block of the chain.
SPAN, BLOCK = 100_000, 64
# Words whose emissions a worker remembers; it forgets them all beyond.
CACHE_WORDS = 400_000
# The two sizes above are for up to so many languages; with more, they shrink in
# proportion, and a chain is followed word by word instead of in blocks.
FEW_LANGUAGES = 16

# The letters of a word; a longer run is cut into successive words.
WORD_LETTERS = 40

_WORD = re.compile(rf"[^\W\d_]{{1,{WORD_LETTERS}}}")


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT


def words(text: str | None) -> list[str]:
    """The runs of letters in a text, in lower case; none if it has no letter.

    A run of more than WORD_LETTERS, as in scripts without blanks, gives several words.
    """
    found = _WORD.findall(text.lower()) if text else []
    return found if any(map(str.isalpha, "".join(found[:64]))) else [
        w for w in found if any(map(str.isalpha, w))
    ]


def features(word: str, lexicon: dict[str, tuple[str, ...]]) -> list[int]:
    """Hashed features: the ends, n-grams of two and three characters, and lexicons."""
    padded = f"^{word}$"
    names = [f"p{word[:n]}" for n in (1, 2, 3) if len(word) >= n]
    names += [f"s{word[-n:]}" for n in (1, 2, 3) if len(word) >= n]
    names += {padded[i : i + n] for n in (2, 3) for i in range(len(padded) - n + 1)}
    names += [f"lexicon {lang}" for lang in lexicon.get(word, ())]
    if word in lexicon:
        names.append(f"word {word}")
    return [crc32(n.encode("utf-8", "surrogatepass")) % BUCKETS for n in names]


@dataclass(frozen=True)
class Model:
    """Weights of features and transitions, and the lexicons of the languages."""

    languages: list[str]
    weights: np.ndarray
    transitions: np.ndarray
    lexicon: dict[str, tuple[str, ...]]
    key: str = field(default_factory=lambda: uuid4().hex)


def emissions(found: list[list[int]], weights: np.ndarray) -> np.ndarray:
    """The summed weights of each word's features."""
    starts = np.cumsum([0] + [len(f) for f in found[:-1]])
    return np.add.reduceat(weights[np.concatenate(found).astype(np.int64)], starts, axis=0)


def marginals(scores: np.ndarray, first: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """The probabilities of labels for chains that stand one after another.

    `scores` are the emissions, `first` marks where a chain begins. A step multiplies
    the forward vector by a matrix; at a beginning all its rows are equal, which starts
    anew. Blocks of steps are multiplied out first, then entered in order.
    """
    n, size = scores.shape
    if size > FEW_LANGUAGES:
        return _word_by_word(scores, first, transitions)
    blocks = -(-n // BLOCK)
    emitted = np.ones((blocks * BLOCK, size))
    emitted[:n] = np.exp(scores - scores.max(axis=1, keepdims=True))
    begins = np.zeros(blocks * BLOCK, bool)
    begins[:n] = first
    begins[n:] = True
    emitted = emitted.reshape(blocks, BLOCK, size).transpose(1, 0, 2)
    begins = begins.reshape(blocks, BLOCK).T[:, :, None, None]
    moves = np.exp(transitions - transitions.max())
    steps = np.where(begins, 1.0, moves[None, None]) * emitted[:, :, None, :]
    whole = np.broadcast_to(np.eye(size), (blocks, size, size))
    for step in steps:
        whole = whole @ step
        whole = whole / whole.sum(axis=(1, 2), keepdims=True)
    entering = np.empty((blocks, size))
    leaving = np.empty((blocks, size))
    vector = np.full(size, 1 / size)
    for i in range(blocks):
        entering[i] = vector
        vector = vector @ whole[i]
        vector = vector / vector.sum()
    vector = np.ones(size)
    for i in range(blocks - 1, -1, -1):
        leaving[i] = vector
        vector = whole[i] @ vector
        vector = vector / vector.sum()
    forward = np.empty((BLOCK, blocks, size))
    vectors = entering
    for t, step in enumerate(steps):
        vectors = np.matmul(vectors[:, None, :], step)[:, 0]
        vectors = vectors / vectors.sum(axis=1, keepdims=True)
        forward[t] = vectors
    vectors = leaving
    for t in range(BLOCK - 1, -1, -1):
        forward[t] *= vectors
        vectors = np.matmul(steps[t], vectors[:, :, None])[:, :, 0]
        vectors = vectors / vectors.sum(axis=1, keepdims=True)
    found = forward.transpose(1, 0, 2).reshape(blocks * BLOCK, size)[:n]
    return found / found.sum(axis=1, keepdims=True)


def _word_by_word(scores: np.ndarray, first: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """The same as `marginals`, without a matrix for each word."""
    emitted = np.exp(scores - scores.max(axis=1, keepdims=True))
    moves = np.exp(transitions - transitions.max())
    forward = np.empty_like(emitted)
    for t in range(len(emitted)):
        vector = emitted[t] if first[t] else vector @ moves * emitted[t]
        vector = forward[t] = vector / vector.sum()
    vector = np.ones(scores.shape[1])
    for t in range(len(emitted) - 1, -1, -1):
        forward[t] *= vector
        vector = np.ones_like(vector) if first[t] else moves @ (emitted[t] * vector)
        vector = vector / vector.sum()
    return forward / forward.sum(axis=1, keepdims=True)


def _sample(docs: DataFrame) -> list[tuple[str, list[str]]]:
    """The words of labelled texts: at most SAMPLE_DOCS of each language, each text whole.

    An id counts once in a language, by one of its texts.
    """
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("id"),
        F.col("text").cast("string"),
        F.col("lang").cast("string"),
    )
    rows = rows.where(
        ~F.coalesce(held_out(F.col("id")), F.lit(False))
        & F.col("id").isNotNull()
        & F.col("lang").isNotNull()
        & (F.length("text") <= SAMPLE_CHARS)
    )
    # Only ids are sorted; each task passes on its best of each language.
    best = Window.partitionBy("lang").orderBy("h", "id")
    known = rows.select("lang", "id", F.xxhash64("id").alias("h"), F.length("text").alias("size"))
    chosen = known.withColumn("place", F.row_number().over(best)).where(F.col("place") <= SAMPLE_DOCS)
    held = chosen.withColumn("held", F.sum("size").over(best)).where(F.col("held") <= SAMPLE_CHARS)
    ids = docs.sparkSession.createDataFrame(held.select("id").distinct().collect(), "id long")
    picked = rows.join(F.broadcast(ids), "id", "left_semi").dropDuplicates(["id", "lang"])

    def make():
        return lambda ids, texts, langs: {
            "id": ids, "lang": langs, "words": [" ".join(words(t)) for t in texts],
        }

    taken = map_batches(picked, make, "id bigint, lang string, words string").collect()
    return [(r["lang"], r["words"].split(" ")) for r in sorted(taken) if r["words"]]


def _lexicon(sample: list[tuple[str, list[str]]]) -> dict[str, tuple[str, ...]]:
    """The languages in whose most frequent words each word is."""
    counts: dict[str, Counter] = {}
    for lang, found in sample:
        counts.setdefault(lang, Counter()).update(set(found))
    lists: dict[str, list[str]] = {}
    for lang, seen in sorted(counts.items()):
        best = sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:LEXICON_WORDS]
        for word, n in best:
            if n > 2:
                lists.setdefault(word, []).append(lang)
    return {w: tuple(x) for w, x in lists.items()}


def _sequences(
    sample: list[tuple[str, list[str]]], index: dict[str, int], rng: np.random.Generator
) -> list[list[tuple[str, int]]]:
    """Training sequences of LENGTH words: stretches of one language after another."""
    stretches = []
    for lang, found in sample:
        at = 0
        while at < len(found):
            size = int(rng.geometric(1 / STRETCH))
            stretches.append([(w, index[lang]) for w in found[at : at + size]])
            at += size
    order = rng.permutation(len(stretches))
    flat = [pair for i in order for pair in stretches[i]]
    return [flat[i : i + LENGTH] for i in range(0, len(flat), LENGTH)]


def train(sample: list[tuple[str, list[str]]]) -> Model:
    """Fit weights and transitions by stochastic gradients of the log-likelihood."""
    rng = np.random.default_rng(9)
    languages = sorted({lang for lang, _ in sample})
    size = len(languages)
    index = {lang: i for i, lang in enumerate(languages)}
    lexicon = _lexicon(sample)
    weights, sums = np.zeros((BUCKETS, size)), np.full((BUCKETS, size), 1e-6)
    moves, move_sums = np.zeros((size, size)), np.full((size, size), 1e-6)
    known = {w: np.unique(features(w, lexicon)) for w in {w for _, x in sample for w in x}}
    for _ in range(PASSES if size > 1 else 0):
        sequences = [s for s in _sequences(sample, index, rng) if len(s) == LENGTH]
        for at in range(0, len(sequences), BATCH):
            batch = sequences[at : at + BATCH]
            found = [known[w] for s in batch for w, _ in s]
            gold = np.array([y for s in batch for _, y in s]).reshape(len(batch), LENGTH)
            scores = emissions(found, weights).reshape(len(batch), LENGTH, size)
            nodes, pairs = _expected(scores, moves)
            nodes[np.arange(len(batch))[:, None], np.arange(LENGTH), gold] -= 1
            np.add.at(pairs, (gold[:, :-1], gold[:, 1:]), -1)
            used = np.concatenate(found)
            each = np.repeat(nodes.reshape(-1, size), [len(f) for f in found], axis=0) / len(batch)
            rows, place = np.unique(used, return_inverse=True)
            slope = np.stack(
                [np.bincount(place, each[:, k], len(rows)) for k in range(size)], axis=1
            )
            slope += SHRINK * weights[rows]
            sums[rows] += slope**2
            weights[rows] -= RATE * slope / np.sqrt(sums[rows])
            pairs = pairs / len(batch)
            move_sums += pairs**2
            moves -= RATE * pairs / np.sqrt(move_sums)
    return Model(languages, weights, moves, lexicon)


def _expected(scores: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Expected labels of each word, and expected transitions in all, for equal chains."""
    emitted = np.exp(scores - scores.max(axis=2, keepdims=True))
    step = np.exp(moves - moves.max())
    n, length, size = scores.shape
    forward, backward = np.empty_like(scores), np.ones_like(scores)
    forward[:, 0] = emitted[:, 0]
    for t in range(1, length):
        forward[:, t - 1] /= forward[:, t - 1].sum(axis=1, keepdims=True)
        forward[:, t] = forward[:, t - 1] @ step * emitted[:, t]
    for t in range(length - 2, -1, -1):
        ahead = (emitted[:, t + 1] * backward[:, t + 1]) @ step.T
        backward[:, t] = ahead / ahead.sum(axis=1, keepdims=True)
    nodes = forward * backward
    nodes /= nodes.sum(axis=2, keepdims=True)
    here, ahead = forward[:, :-1], (emitted * backward)[:, 1:]
    here = here / (here @ step * ahead).sum(axis=2, keepdims=True)
    return nodes, step * (here.reshape(-1, size).T @ ahead.reshape(-1, size))


def fit(docs: DataFrame) -> Model:
    """Learn from the ``text`` and ``lang`` of documents that are not held out.

    Null texts and languages are left out. Without labels, all texts are UNKNOWN.
    """
    return train(_sample(docs))


class Emitter:
    """The emissions of words, worked out once each and kept in one growing table."""

    def __init__(self, model: Model):
        self.model = model
        self.limit = CACHE_WORDS * FEW_LANGUAGES // max(len(model.languages), FEW_LANGUAGES)
        self._clear()

    def _clear(self) -> None:
        self.rows: dict[str, int] = {}
        self.table = np.empty((1 << 12, len(self.model.languages)))

    def scores(self, found: list[str]) -> np.ndarray:
        new = list(set(found).difference(self.rows))
        if len(self.rows) + len(new) > self.limit:
            self._clear()
            new = list(set(found))
        for at in range(0, len(new), 4096):
            part = new[at : at + 4096]
            base = len(self.rows)
            while base + len(part) > len(self.table):
                self.table = np.concatenate([self.table, np.empty_like(self.table)])
            known = [features(w, self.model.lexicon) for w in part]
            self.table[base : base + len(part)] = emissions(known, self.model.weights)
            self.rows.update(zip(part, range(base, base + len(part)), strict=True))
        return self.table[np.fromiter(map(self.rows.__getitem__, found), np.int64, len(found))]


def _cached(model: Model) -> Emitter:
    """The worker's emitter, kept for its next task."""
    return held("language", model.key, lambda: Emitter(model))


def label(texts: list[str | None], emitter: Emitter) -> list[tuple[str, float, str]]:
    """Per text its language, the mean probability of it and the share of each language."""
    model, size = emitter.model, len(emitter.model.languages)
    result: list[tuple[str, float, str]] = [(UNKNOWN, 0.0, "")] * len(texts)
    if not size:
        return result
    pending: list[tuple[int, list[str]]] = []

    def flush():
        if not pending:
            return
        lengths = np.array([len(w) for _, w in pending])
        starts = np.cumsum(lengths) - lengths
        first = np.zeros(lengths.sum(), bool)
        first[starts] = True
        scores = emitter.scores([w for _, found in pending for w in found])
        shares = np.add.reduceat(marginals(scores, first, model.transitions), starts, axis=0)
        shares = np.clip(shares / lengths[:, None], 0.0, 1.0)
        for (i, _), share in zip(pending, shares, strict=True):
            best = int(np.argmax(share))
            mixed = ",".join(f"{n}:{x:.2f}" for n, x in zip(model.languages, share, strict=True) if x >= 0.05)
            result[i] = model.languages[best], float(share[best]), mixed
        pending.clear()

    total = 0
    for i, text in enumerate(texts):
        found = words(text)
        if found:
            pending.append((i, found))
            total += len(found)
        if total * max(size, FEW_LANGUAGES) >= SPAN * FEW_LANGUAGES:
            flush()
            total = 0
    flush()
    return result


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` (0 to 1) and ``languages`` of every document.

    ``languages`` lists the share of each language of at least 5 %. A text that is null
    or has no letter is UNKNOWN with score 0. One row per row of `docs`; other columns
    are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        emitter = _cached(shared.value)

        def step(ids, texts):
            found = label(texts, emitter)
            return {
                "doc_id": ids,
                "lang_pred": [x[0] for x in found],
                "score": [x[1] for x in found],
                "languages": [x[2] for x in found],
            }

        return step

    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return map_batches(texts, make, "doc_id bigint, lang_pred string, score double, languages string")
