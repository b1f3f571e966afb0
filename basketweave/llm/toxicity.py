"""Toxic passages by maximum-scoring segments of token log-odds.

A token's score is its log-odds between toxic and clean labelled documents under a
Dirichlet prior that follows the frequencies of both, drawn towards zero by its
standard error, less a constant drift. Words also vote by their beginnings, so forms
of a word that was never labelled are scored too.

Ruzzo and Tompa's linear scan finds all maximal segments of a document. By
Karlin-Altschul statistics a segment of score `S` among `n` tokens has the expected
number ``K n exp(-lambda S)`` in clean text; its logarithm makes documents of any
length comparable, and a logistic curve over it gives the score of a document.

Counting is done by Spark over all labelled rows, and every feature with a score counts.
Features are broadcast while they fit the bound of lookup tables; more of them stay in a
table, and the words of the documents are looked up by shuffle joins before the scan, with
the same result. The curve is fitted on a histogram.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, field, replace
from math import exp, log, pi, sqrt
from uuid import uuid4

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketweave.functions.joins import fits_broadcast, lookup_join
from basketweave.llm.common import Memo, filter_batches, held, map_batches
from basketweave.workspace import Table, Workspace

# Labels are learned where the CRC of the document's id, modulo FOLDS, is not HELD_OUT.
FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.7
# Weight of the prior, in tokens, shared out by frequency; what each feature gets besides;
# and the standard errors by which log-odds are reduced.
PRIOR, EACH, CAUTION = 500.0, 0.5, 1.96
# What each token costs a segment.
DRIFT = 0.5
# Beginnings of a word that count as features, in characters.
BEGINNINGS = (4, 5, 6)
# What a feature takes in a worker's dictionary besides its characters; a row of words
# that were looked up besides them.
FEATURE_BYTES, ROW_BYTES = 280, 64
# Segments with at most this expected number in clean text are significant.
SIGNIFICANT = 0.01
# The logarithm of the length that stands for a text without any segment.
NOTHING = log(1 << 20)
# A label and its document's id in a broadcast table.
ID_BYTES = 96

_WORD = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class Model:
    """Token scores and the calibration of segment scores."""

    features: dict[str, tuple[float, float]]  # |z| and score, by word or beginning
    slope: float = 1.0  # lambda
    size: float = 0.0  # log K
    intercept: float = -4.0
    weight: float = 0.0
    key: str = field(default_factory=lambda: uuid4().hex)
    # Where the features are, with z and score, if they are too many to broadcast.
    table: Table | None = None
    ws: Workspace | None = None

    def evidence(self, top: float, tokens: int) -> float:
        """Minus the logarithm of the expected number of such segments by chance.

        Without a segment it is that of a very long text, whatever the length.
        """
        length = log(max(tokens, 1)) if top > 0 else NOTHING
        return max(-20.0, min(40.0, self.slope * top - self.size - length))

    def probability(self, top: float, tokens: int) -> float:
        value = self.intercept + self.weight * self.evidence(top, tokens)
        return 1 / (1 + exp(-max(-500.0, min(500.0, value))))


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT


def tokens(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal segments of `scores` as start, end and sum, in order.

    Ruzzo and Tompa's algorithm; each candidate points to the nearest one before it
    with a lower sum to its left, which keeps the search linear.
    """
    total = np.concatenate(([0.0], np.cumsum(scores)))
    found: list[list] = []  # start, end, sum before, sum through, candidate to look at
    for at in np.flatnonzero(scores > 0).tolist():
        start, end, left, right = at, at + 1, float(total[at]), float(total[at + 1])
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= left:
                j = found[j][4]
            if j < 0 or found[j][3] >= right:
                found.append([start, end, left, right, j])
                break
            start, left = found[j][0], found[j][2]
            del found[j:]
    return [(a, b, right - left) for a, b, left, right, _ in found]


class Scorer:
    """The scores of words, worked out once each."""

    def __init__(self, model: Model):
        self.model = model
        self.known = Memo(self._score)

    def _score(self, word: str) -> float:
        found = [self.model.features.get(word)]
        found += [self.model.features.get(word[:n] + "*") for n in BEGINNINGS if len(word) > n]
        return max((f for f in found if f), default=(0.0, 0.0))[1] - DRIFT

    def scores(self, text: str | None, hits: list | None = None) -> np.ndarray:
        """The scores of a text's tokens; `hits` are words that were looked up for it."""
        found = tokens(text)
        if hits is None:
            return np.fromiter(map(self.known.__getitem__, found), float, len(found))
        known = dict(hits)
        return np.fromiter((known.get(w, 0.0) - DRIFT for w in found), float, len(found))


def _cached(model: Model) -> Scorer:
    """The worker's scorer, kept for its next task."""
    return held("toxicity", model.key, lambda: Scorer(model))


def _labelled(docs: DataFrame, labels: DataFrame, ws: Workspace) -> DataFrame:
    """Texts that may be learned from, equal texts once, toxic if any label says so.

    Only ids and hashes of texts are shuffled; the texts are looked up again.
    """
    marks = (
        labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("toxic"))
        .where(~held_out(F.col("id")) & F.col("toxic").isNotNull())
        .groupBy("id")
        .agg(F.max("toxic").alias("toxic"))
    )
    texts = docs.select(F.col("doc_id").alias("id"), F.col("text").cast("string")).where(
        "text IS NOT NULL"
    )

    def marked(table: Table) -> DataFrame:
        small = F.broadcast(table.df) if fits_broadcast(table.rows, ID_BYTES) else table.df
        return texts.join(small, "id")

    hashed = marked(ws.write("marks", marks)).select(
        "id", "toxic", F.xxhash64("text").alias("hash"), F.length("text").alias("length")
    )
    first = hashed.groupBy("hash", "length").agg(F.min("id").alias("id"), F.max("toxic").alias("toxic"))
    return marked(ws.write("first", first.select("id", "toxic"))).select("text", "toxic")


def _counts(rows: DataFrame) -> DataFrame:
    """Per word or beginning, in how many toxic and clean texts its words stand."""
    word = F.explode(
        F.array_distinct(
            F.regexp_extract_all(F.lower("text"), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))
        )
    )
    each = (
        rows.select(word.alias("word"), "toxic")
        .groupBy("word")
        .agg(F.sum("toxic").alias("y1"), F.sum(1 - F.col("toxic")).alias("y0"))
    )
    marked = [
        F.when(F.length("word") > n, F.concat(F.substring("word", 1, n), F.lit("*")))
        for n in BEGINNINGS
    ]
    features = F.explode(F.array_compact(F.array(F.col("word"), *marked)))
    return (
        each.select(features.alias("feature"), "y1", "y0")
        .groupBy("feature")
        .agg(F.sum("y1").alias("y1"), F.sum("y0").alias("y0"))
    )


def _log_odds(table: Table, ws: Workspace) -> Model:
    """All features of a table of counts that have a score, with |z| and score."""
    counts, n1, n0 = table.df, table.stats["y1"], table.stats["y0"]
    if not n1 or not n0:
        return Model({})
    prior = EACH + PRIOR * (F.col("y1") + F.col("y0")) / (n1 + n0)

    def side(seen: str, whole: float) -> Column:
        return F.log((F.col(seen) + prior) / (whole + PRIOR - F.col(seen) - prior))

    scored = counts.select(
        "feature",
        (side("y1", n1) - side("y0", n0)).alias("odds"),
        F.sqrt(1 / (F.col("y1") + prior) + 1 / (F.col("y0") + prior)).alias("error"),
    ).select(
        "feature",
        (F.abs("odds") / F.col("error")).alias("z"),
        (F.signum("odds") * F.greatest(F.abs("odds") - CAUTION * F.col("error"), F.lit(0))).alias(
            "score"
        ),
    )
    kept = ws.write("features", scored.where("score <> 0"), size=F.sum(F.octet_length("feature")))
    if fits_broadcast(1, kept.rows * FEATURE_BYTES + kept.stats["size"]):
        return Model({r["feature"]: (r["z"], r["score"]) for r in kept.df.collect()})
    return Model({}, table=kept, ws=ws)


def _with_hits(rows: DataFrame, model: Model) -> DataFrame:
    """`rows`, which have ``text``, with ``hits``: its words that have a score.

    Null where the model holds its features. Words are joined once for each distinct
    text, named by its hash.
    """
    kind, ws = "map<string,double>", model.ws
    if not model.table:
        return rows.withColumn("hits", F.lit(None).cast(kind))
    key = F.unhex(F.md5("text"))

    def make():
        return lambda keys, texts: {"key": keys, "words": [list(set(tokens(t))) for t in texts]}

    texts = rows.where("text IS NOT NULL").select(key.alias("key"), "text")
    pairs = ws.write(
        "pairs",
        map_batches(texts, make, "key binary, words array<string>")
        .select("key", F.explode("words").alias("word"))
        .distinct(),
    )
    marked = [
        F.when(F.length("word") > n, F.concat(F.substring("word", 1, n), F.lit("*")))
        for n in BEGINNINGS
    ]
    votes = F.explode(F.array_compact(F.array(F.col("word"), *marked))).alias("feature")
    asked = pairs.df.select("word").distinct().select("word", votes)
    features = model.table
    bytes_ = ROW_BYTES + features.stats["size"] // features.rows
    known = lookup_join(asked, features.df, "feature", features.rows, bytes_, ["word"])
    scores = ws.write(
        "scores",
        known.groupBy("word").agg(F.max(F.struct("z", "score")).alias("best")).select("word", "best.score"),
        size=F.sum(F.octet_length("word")),
    )
    bytes_ = ROW_BYTES + scores.stats["size"] // max(scores.rows, 1)
    found = lookup_join(pairs.df, scores.df, "word", scores.rows, bytes_, ["key"])
    entries = F.map_from_entries(F.collect_list(F.struct("word", "score")))
    hits = ws.write(
        "hits", found.groupBy("key").agg(entries.alias("hits")), words=F.sum(F.size("hits"))
    )
    bytes_ *= 1 + hits.stats["words"] // max(hits.rows, 1)
    columns = [c for c in rows.columns if c != "hits"]
    spread = rows.select(*columns, key.alias("key"), F.monotonically_increasing_id().alias("at"))
    joined = lookup_join(spread, hits.df, "key", hits.rows, bytes_, ["at"], "left")
    return joined.select(*columns, F.coalesce("hits", F.create_map().cast(kind)).alias("hits"))


def _calibrate(model: Model, bins: Iterable) -> Model:
    """Fit lambda and K on clean documents, then the logistic curve on all."""
    bins = list(bins)
    toxic, size, top, n = (np.array([r[c] for r in bins], float) for c in ("toxic", "size", "top", "n"))
    clean = n * (toxic == 0)
    if not clean.any() or not (n * toxic).any():
        return model
    slope = 1.0
    for _ in range(50):  # the spread of a Gumbel variable is pi / sqrt(6)
        rest = top - size / slope
        mean = np.average(rest, weights=clean)
        spread = sqrt(np.average((rest - mean) ** 2, weights=clean))
        slope = min(5.0, max(0.2, pi / sqrt(6) / max(spread, 1e-6)))
    level = float(np.average(slope * top - size, weights=clean)) - np.euler_gamma
    x = np.clip(slope * top - level - np.where(top > 0, size, NOTHING), -20.0, 40.0)
    beta = np.zeros(2)
    design = np.stack([np.ones_like(x), x], axis=1)
    for _ in range(60):  # a small penalty keeps separable labels finite
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (n * (toxic - p)) - 1e-2 * beta
        curve = (design * (n * p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        beta = beta + np.clip(np.linalg.solve(curve, gradient), -1, 1)
    return replace(
        model,
        slope=slope,
        size=level,
        intercept=float(beta[0]),
        weight=float(max(beta[1], 0.0)),
        key=uuid4().hex,
    )


def fit(docs: DataFrame, labels: DataFrame, ws: Workspace) -> Model:
    """Learn from the documents that `labels` (``doc_id``, ``toxic``) marks.

    Held-out ids, null labels and null texts are left out; several labels of a document
    count as toxic if one is, and equal texts count once. Without documents of both
    classes the model scores everything low.
    """
    rows = _labelled(docs, labels, ws)
    counts = ws.write("counts", _counts(rows), y1=F.sum("y1"), y0=F.sum("y0"))
    model = _log_odds(counts, ws)
    sent = replace(model, table=None, ws=None)

    def make():
        scorer = _cached(sent)

        def step(texts, toxic, hits):
            scores = [scorer.scores(t, h) for t, h in zip(texts, hits, strict=True)]
            tops = [max((s for *_, s in segments(x)), default=0.0) for x in scores]
            return {
                "toxic": toxic,
                "size": [round(4 * log(max(len(x), 1))) / 4 for x in scores],
                "top": [min(round(4 * t) / 4, 100.0) for t in tops],
            }

        return step

    looked_up = _with_hits(rows.select("text", "toxic"), model)
    scored = map_batches(looked_up, make, "toxic int, size double, top double")
    bins = scored.groupBy("toxic", "size", "top").agg(F.count(F.lit(1)).alias("n"))
    return _calibrate(model, bins.collect())


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per document its toxicity and its significant passages.

    ``doc_id``, ``score`` (0 to 1), ``top`` (the best segment's score) and ``passages``,
    each significant segment as ``start:end`` in tokens, end exclusive, joined by
    commas. A null or empty text scores as clean. One row per row of `docs`; other
    columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(replace(model, table=None, ws=None))

    def make():
        scorer = _cached(shared.value)

        def step(ids, texts, hits):
            out = {"doc_id": ids, "score": [], "top": [], "passages": []}
            for text, known in zip(texts, hits, strict=True):
                values = scorer.scores(text, known)
                found, n = segments(values), len(values)
                top = max((s for *_, s in found), default=0.0)
                out["score"].append(scorer.model.probability(top, n))
                out["top"].append(top)
                limit = -log(SIGNIFICANT)
                out["passages"].append(
                    ",".join(
                        f"{a}:{b}" for a, b, s in found if scorer.model.evidence(s, n) >= limit
                    )
                )
            return out

        return step

    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return map_batches(_with_hits(texts, model), make, "doc_id bigint, score double, top double, passages string")


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` whose ``text`` scores below `threshold`; all columns stay.

    The text alone decides: ids may be null or repeated, and a row without text stays.
    """
    shared = docs.sparkSession.sparkContext.broadcast(replace(model, table=None, ws=None))

    def make():
        scorer = _cached(shared.value)

        def clean(text, hits=None):
            values = scorer.scores(text, hits)
            top = max((s for *_, s in segments(values)), default=0.0)
            return scorer.model.probability(top, len(values)) < threshold

        return lambda *columns: [clean(*x) for x in zip(*columns, strict=True)]

    if not model.table:
        return filter_batches(docs, ["text"], make)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    looked_up = _with_hits(docs.select(row, F.col("text").cast("string")), model)
    return filter_batches(looked_up, ["text", "hits"], make).select("row.*")
