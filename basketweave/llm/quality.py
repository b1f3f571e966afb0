"""Text quality by support vectors over naive Bayes features.

A text is the set of its n-grams: of its words, and of their shapes, which tell capitals,
digits, marks and lengths apart in any language; and of what its lines are like. Each
n-gram is an indicator in one of BUCKETS hash buckets, scaled by the logarithm of how much
likelier labelled texts of class 1 have it than those of class 0. Over these a linear
model with the hinge loss is fitted by dual coordinate descent, and a logistic curve over
its margin, fitted on texts that the model has not seen, gives the score.

The ratios count every labelled text; Spark sums them by bucket. The model, one weight for
each bucket, is fitted on a bounded sample of texts by class and moved towards the mean
weight, so buckets that the sample lacks still count by their ratio.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from uuid import uuid4

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketweave.functions.joins import fits_broadcast
from basketweave.llm.common import CACHE_BYTES, ENTRY_BYTES, held, map_arrow, map_batches
from basketweave.workspace import Workspace

# Labels are learned where the CRC of the document's id, modulo FOLDS, is not HELD_OUT.
FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.5
# Hash buckets of n-grams, and the longest n-grams of words and of shapes.
BUCKETS = 1 << 18
WORD_ORDER, SHAPE_ORDER = 2, 3
# Labelled texts of a class that the linear model sees, and the bound on the features of
# all of them together; every CHECK-th of them fits the curve instead.
SAMPLE, SAMPLE_FEATURES, CHECK = 3_000, 8_000_000, 5
# Added to the counts of both classes; the cost of a violated margin; passes over the
# sample at most; the change that ends them; the share of the fitted weights in the model.
SMOOTHING, COST, PASSES, TOLERANCE, FITTED = 1.0, 1.0, 30, 1e-3, 0.5
# A label and its document's id in a broadcast table.
ID_BYTES = 96

_TOKEN = re.compile(r"[^\W\d_]+|\d+|\n+|[^\w\s]+|_+")
_STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Model:
    """A weight for each bucket, and the curve over the margin."""

    weights: np.ndarray
    bias: float = 0.0
    slope: float = 1.0
    shift: float = 0.0
    key: str = field(default_factory=lambda: uuid4().hex)

    def margins(self, sets: list[np.ndarray]) -> np.ndarray:
        sums = np.array([float(self.weights[s].sum()) for s in sets])
        return sums / np.sqrt([max(len(s), 1) for s in sets]) + self.bias

    def probabilities(self, sets: list[np.ndarray]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(sets) + self.shift, -30, 30)))


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT


def shape(token: str) -> str:
    """How a token looks: its kind, capitals and length, roughly."""
    first = token[0]
    size = str(len(token).bit_length())
    if first == "\n":
        return "n"
    if first.isdigit():
        return "0" + size
    if first.isalpha():
        capitals = "A" if token.isupper() and len(token) > 1 else "a" if token.islower() else "Aa"
        return capitals + size
    return "".join(sorted(set(token)))[:4] + (size if len(token) > 1 else "")


class Tokens(dict):
    """Numbers of tokens, and by number the hashes of a token's lower-case form and shape.

    Beyond CACHE_BYTES all tokens are forgotten, between two texts.
    """

    def __init__(self):
        super().__init__()
        self.room = CACHE_BYTES
        self.hashes = np.zeros((1024, 2), np.uint64)
        self.kinds = np.zeros((1024, 2), bool)  # letters, capitals

    def __missing__(self, token: str) -> int:
        number = len(self)
        if number == len(self.hashes):
            self.hashes = np.concatenate([self.hashes, np.zeros_like(self.hashes)])
            self.kinds = np.concatenate([self.kinds, np.zeros_like(self.kinds)])
        word = xxhash.xxh3_64_intdigest(token.lower().encode("utf-8", "surrogatepass"))
        self.hashes[number] = word, xxhash.xxh3_64_intdigest("s" + shape(token))
        self.kinds[number] = token[0].isalpha(), token.isupper()
        self.room -= ENTRY_BYTES + len(token)
        self[token] = number
        return number

    def numbers(self, found: list[str]) -> np.ndarray:
        if self.room < 0:
            self.clear()
            self.room = CACHE_BYTES
        return np.fromiter(map(self.__getitem__, found), np.int64, len(found))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values, sorted; faster on short arrays than hashing them."""
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])[: len(values)]]


def _share(part: int, whole: int) -> int:
    """A share in steps of a tenth."""
    return 10 * part // max(whole, 1)


def _whole(text: str, tokens: int, distinct: int, letters: int, capitals: int) -> list[str]:
    """What the text is like as a whole: its size, its repeats and its marks."""
    lines = [line for line in text.split("\n") if line.strip()]
    return [
        f"size {tokens.bit_length()}",
        f"new {_share(distinct, tokens)}",
        f"lines {_share(len(set(lines)), len(lines))} {min(len(lines), 4)}",
        f"letters {_share(letters, tokens)}",
        f"capitals {_share(capitals, tokens)}",
        f"short {_share(tokens, len(lines)) // 20 if lines else -1}",
    ]


def features(text: str | None) -> np.ndarray:
    """The distinct buckets of a text's n-grams, sorted; those of an empty one if null."""
    text = text or ""
    found = _TOKEN.findall(text)
    known = held("quality", None, Tokens)
    numbers = known.numbers(found)
    hashed = known.hashes[numbers]
    rows = []
    for column, order in ((0, WORD_ORDER), (1, SHAPE_ORDER)):
        value = np.full(len(found), column, np.uint64)
        for n in range(min(order, len(found))):
            value = value[: len(found) - n] * _STEP + hashed[n:, column]
            rows.append(_mixed(value))
    letters, capitals = known.kinds[numbers].sum(axis=0).tolist()
    marks = _whole(text, len(found), len(_distinct(numbers)), letters, capitals)
    rows.append(np.array([xxhash.xxh3_64_intdigest(w) for w in marks], np.uint64))
    buckets = (np.concatenate(rows) >> np.uint64(20)) % np.uint64(BUCKETS)
    return _distinct(buckets.astype(np.int32))


def _labelled(docs: DataFrame, labels: DataFrame, ws: Workspace) -> DataFrame:
    """``key``, ``text``, ``label`` of rows to learn from; of several labels the least."""
    marks = (
        labels.select(F.col("doc_id").alias("id"), F.col("quality").cast("int").alias("label"))
        .where(~held_out(F.col("id")) & F.col("label").isin(0, 1))
        .groupBy("id")
        .agg(F.min("label").alias("label"))
    )
    kept = ws.write("marks", marks)
    small = F.broadcast(kept.df) if fits_broadcast(kept.rows, ID_BYTES) else kept.df
    texts = docs.select(F.col("doc_id").alias("id"), F.col("text").cast("string")).where("text IS NOT NULL")
    return texts.join(small, "id").select(F.xxhash64("id", "text").alias("key"), "text", "label")


def _counts(rows: DataFrame) -> DataFrame:
    """Texts with each bucket by class, ``(bucket, y1, y0)``; bucket -1 counts the texts.

    A task sums its texts in one array of all buckets before it passes them on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, texts = np.zeros((2, BUCKETS), np.int64), np.zeros(2, np.int64)
        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                seen[label, features(text.as_py())] += 1
                texts[label] += 1
        if texts.any():
            used = np.flatnonzero(seen.any(axis=0))
            buckets = np.append(used, -1)
            sums = [np.append(seen[y, used], texts[y]) for y in (1, 0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in (buckets, *sums)], names=["bucket", "y1", "y0"]
            )

    partial = map_arrow(rows.select("text", "label"), run, "bucket bigint, y1 bigint, y0 bigint")
    return partial.groupBy("bucket").agg(F.sum("y1").alias("y1"), F.sum("y0").alias("y0"))


def _sample(rows: DataFrame, ws: Workspace) -> tuple[list[np.ndarray], np.ndarray]:
    """The bucket lists and labels of up to SAMPLE texts of each class, drawn by hash.

    Lists are taken in that order until SAMPLE_FEATURES are held, 4 bytes each, so long
    texts cannot fill the driver.
    """
    drawn = W.partitionBy("label").orderBy("key")
    keys = rows.select("key", "label").distinct().withColumn("at", F.row_number().over(drawn))
    picked = F.broadcast(ws.write("keys", keys.where(F.col("at") <= SAMPLE)).df)

    def make():
        return lambda at, label, texts: {
            "at": at, "label": label, "buckets": [features(t) for t in texts],
        }

    listed = map_batches(
        rows.join(picked, ["key", "label"]).select("at", "label", "text"),
        make,
        "at int, label int, buckets array<bigint>",
    )
    table = ws.write("sample", listed.dropDuplicates(["at", "label"])).df
    before = F.sum(F.size("buckets")).over(W.orderBy("at", "label"))
    small = table.select("at", "label", before.alias("held")).where(F.col("held") <= SAMPLE_FEATURES)
    kept = table.select("at", "label", F.col("buckets").cast("array<int>").alias("buckets"))
    kept = kept.join(F.broadcast(small.select("at", "label")), ["at", "label"])
    found = kept.orderBy("at", "label").toArrow()
    lists = [x.values.to_numpy() for x in found.column("buckets")]
    return lists, found.column("label").to_numpy().astype(float)


def descend(sets: list[np.ndarray], signs: np.ndarray, ratios: np.ndarray, costs: np.ndarray) -> np.ndarray:
    """The weights of the hinge loss by dual coordinate descent, bias last.

    Row i has ``ratios[sets[i]] / sqrt(len)`` and a one for the bias; `costs` bound the
    dual variables, one for each row.
    """
    weights, bias, alphas = np.zeros(len(ratios)), 0.0, np.zeros(len(sets))
    values = [(ratios[s] / np.sqrt(max(len(s), 1))).astype(np.float32) for s in sets]
    norms = np.array([float(v @ v) + 1 for v in values])
    rng = np.random.default_rng(13)
    for _ in range(PASSES):
        widest = 0.0
        for i in rng.permutation(len(sets)):
            s, v, y = sets[i], values[i], signs[i]
            slope = y * (weights[s] @ v + bias) - 1
            new = min(max(alphas[i] - slope / norms[i], 0.0), costs[i])
            step = new - alphas[i]
            if step:
                weights[s] += step * y * v
                bias += step * y
                alphas[i] = new
                widest = max(widest, abs(step) / costs[i])
        if widest < TOLERANCE:
            break
    return np.append(weights, bias)


def _curve(margins: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve over margins; a small penalty keeps it finite."""
    beta = np.array([0.0, 1.0])
    design = np.stack([np.ones_like(margins), margins], axis=1)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (weights * (labels - p)) - 0.1 * (beta - [0.0, 1.0])
        curve = (design * (weights * p * (1 - p))[:, None]).T @ design + 0.1 * np.eye(2)
        beta = beta + np.clip(np.linalg.solve(curve, gradient), -2, 2)
    return float(max(beta[1], 0.0)), float(beta[0])


def fit(docs: DataFrame, labels: DataFrame, ws: Workspace) -> Model:
    """Learn from the documents that `labels` (``doc_id``, ``quality``) marks.

    Held-out ids, labels other than 0 and 1 and null texts are left out; a document with
    several labels has the least. Without texts of both classes every score is 0.5.
    """
    rows = _labelled(docs, labels, ws)
    counts = ws.write("counts", _counts(rows)).df.toArrow()  # a row for each bucket at most
    bucket, y1, y0 = (counts.column(c).to_numpy() for c in ("bucket", "y1", "y0"))
    seen, texts = np.zeros((2, BUCKETS)), np.zeros(2)
    seen[0, bucket[bucket >= 0]], seen[1, bucket[bucket >= 0]] = y0[bucket >= 0], y1[bucket >= 0]
    texts[:] = y0[bucket < 0].sum(), y1[bucket < 0].sum()
    if not texts.all():
        return Model(np.zeros(BUCKETS, np.float32), slope=0.0)
    smoothed = (seen + SMOOTHING) / (texts[:, None] + 2 * SMOOTHING)
    ratios = np.where(seen.any(axis=0), np.log(smoothed[1] / smoothed[0]), 0.0)

    sets, labels_ = _sample(rows, ws)
    # Each class weighs as much as the other in the model, and as in the corpus in the curve.
    sizes = np.array([(labels_ == y).sum() for y in (0, 1)])
    share = texts / texts.sum() / np.maximum(sizes, 1) * sizes.sum()
    checks = np.arange(len(sets)) % CHECK == CHECK - 1
    if not all(((labels_ == y) & ~checks).any() for y in (0, 1)):
        checks[:] = False
    learned = np.flatnonzero(~checks)
    costs = COST * sizes.sum() / (2 * sizes[labels_[learned].astype(int)])
    found = descend([sets[i] for i in learned], 2 * labels_[learned] - 1, ratios, costs)
    fitted, bias = found[:-1], float(found[-1])
    used = fitted[fitted != 0]
    mean = float(np.abs(used).mean()) if len(used) else 1.0
    weights = (FITTED * fitted + (1 - FITTED) * mean) * ratios
    model = Model(weights.astype(np.float32), bias)
    tested = np.flatnonzero(checks) if checks.any() else learned
    margins = model.margins([sets[i] for i in tested])
    slope, shift = _curve(margins, labels_[tested], share[labels_[tested].astype(int)])
    return Model(model.weights, bias, slope, shift)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``score`` (0 to 1) and ``margin`` of every row; a null text is empty.

    One row per row of `docs`, repeated and null ids included; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS weights of 4 bytes

    def make():
        known = shared.value

        def step(ids, texts):
            sets = [features(t) for t in texts]
            return {"doc_id": ids, "score": known.probabilities(sets), "margin": known.margins(sets)}

        return step

    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return map_batches(texts, make, "doc_id bigint, score double, margin double")
