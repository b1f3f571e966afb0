"""Approximate nearest neighbours by collision counting.

Vectors are mapped so that the largest inner product is the smallest distance. Each of
PROJECTIONS random lines gives a sorted array of the vectors' places on it, cut into
equal buckets. A query opens a window around its own place on every line; the windows
widen in small steps (virtual rehashing: nothing is hashed anew), and the vectors that
are inside often enough are verified by their exact inner product. The windows are the
narrowest ones in which as many vectors as the budget asks for collide that often. The
budget grows with the root of the number of vectors, so the share that is verified falls.
In a large block, collisions are first counted on the few lines where the query lies
farthest out, as the fewest vectors are near it there. Those that collide most often, several
times the budget, go on to the windows on all lines.

All vectors are indexed. Spark deals them into blocks of a bounded size, and each block's
index is built once and written; the queries, which are far fewer, go to the blocks, in
blocks of their own, and the best of all blocks are merged.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketweave.llm.common import importable
from basketweave.workspace import Workspace

# Vectors and queries in a block, on average.
BLOCK_VECTORS, BLOCK_QUERIES = 8_192, 16_384
# Lines, fewer than the counts that a byte holds, and buckets of a line, as many as it names.
PROJECTIONS, BUCKETS = 240, 256
# Half the widths of the windows, step by step; the last one holds everything.
WIDTHS = np.append(0.02 * 1.04 ** np.arange(132), np.inf)
# A vector is verified once it is inside this share of the windows.
COLLISIONS = 0.75
# A query verifies so many vectors for each root of their number, and k + 1 of each block.
BUDGET = 5.0
# The lines of the first round, and the buckets on either side of a query's own. How many
# vectors go on: so many times the budget, and so many at least. A block that has no more of
# them has no first round.
FIRST_LINES, NEAR = 32, 64
KEPT, LEAST_KEPT = 6, 1_024
FOUND = "query long, query_id long, vec_id long, score double, verified long"
INDEX = (
    "dimension int, wide long, ids binary, vectors binary, single boolean, codes binary, edges binary"
)


def usable(vector: Column) -> Column:
    """Whether a vector has numbers only, and one that is not zero."""
    parts = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(
        parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    )
    return F.coalesce(finite & F.exists(parts, lambda x: x != 0), F.lit(False))


def lines(dimension: int) -> np.ndarray:
    """The random lines for vectors of a dimension, the added one last."""
    return np.random.default_rng(dimension).standard_normal((dimension + 1, PROJECTIONS))


def windows(above: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first bucket of the window from `low` to `high` on each line, and how many follow it."""
    first = np.add.reduce((above < low).view(np.uint8), axis=0, dtype=np.uint8)
    last = np.add.reduce((above <= high).view(np.uint8), axis=0, dtype=np.uint8)
    return first, last - first


class Index:
    """The bucketed projections of a block of vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, codes: np.ndarray, edges: np.ndarray):
        self.ids, self.vectors, self.codes, self.edges = ids, vectors, codes, edges
        self.lines = lines(vectors.shape[1])[:-1]
        # Edges by number, then by line; the first bucket also holds what is below it.
        self._above = np.ascontiguousarray(edges[:, 1:].T)
        # The codes of a vector side by side, to pick vectors.
        self._by_vector = np.ascontiguousarray(codes.T)
        self._scratch = np.empty((2, codes.size), np.uint8)

    @classmethod
    def build(cls, ids: np.ndarray, vectors: np.ndarray, longest: float) -> Index:
        """Sort the places on each line; a bucket holds an equal share of the array."""
        n = len(ids)
        unit = vectors.astype(float) / longest
        rest = np.sqrt(np.maximum(0.0, 1.0 - (unit**2).sum(axis=1)))
        random = lines(vectors.shape[1])
        places = np.ascontiguousarray((unit @ random[:-1] + rest[:, None] * random[-1]).T)
        order = np.argsort(places, axis=1, kind="stable")
        bucket = np.arange(n) * min(BUCKETS, n) // n
        codes = np.empty(places.shape, np.uint8)
        np.put_along_axis(codes, order, np.broadcast_to(bucket, places.shape).astype(np.uint8), axis=1)
        first = order[:, np.flatnonzero(np.diff(bucket, prepend=-1))]
        return cls(ids, vectors, codes, np.take_along_axis(places, first, axis=1))

    def row(self) -> dict:
        """The arrays as bytes, for a table."""
        return {
            "ids": self.ids.astype("<i8").tobytes(),
            "vectors": self.vectors.tobytes(),
            "single": self.vectors.dtype == np.float32,
            "codes": self.codes.tobytes(),
            "edges": self.edges.tobytes(),
        }

    @classmethod
    def read(cls, row: dict) -> Index:
        ids = np.frombuffer(row["ids"], "<i8")
        kind = np.float32 if row["single"] else np.float64
        return cls(
            ids,
            np.frombuffer(row["vectors"], kind).reshape(len(ids), -1),
            np.frombuffer(row["codes"], np.uint8).reshape(PROJECTIONS, -1),
            np.frombuffer(row["edges"], np.float64).reshape(PROJECTIONS, -1),
        )

    def _inside(self, codes: np.ndarray, low: np.ndarray, more: np.ndarray) -> np.ndarray:
        """1 for each code from `low` on, and up to `more` further; held until the next call."""
        moved, inside = (x[: codes.size].reshape(codes.shape) for x in self._scratch)
        # Bytes wrap around, so one comparison tests both ends.
        np.subtract(codes, low, out=moved)
        np.less_equal(moved, more, out=inside.view(bool))
        return inside

    def first_round(self, at: np.ndarray, wanted: int) -> np.ndarray:
        """The `wanted` vectors, or some more, that are near `at` most often.

        Near are the buckets that hold `at` and NEAR on either side, with all that begin at
        the same place; only the lines where `at` lies farthest out are looked at.
        """
        last = len(self._above)
        first, more = (x.astype(int) for x in windows(self._above, at, at))
        out = np.argsort(-np.abs(2 * first + more - last), kind="stable")[:FIRST_LINES]
        low = np.maximum(first[out] - NEAR - 1, 0)
        high = np.minimum(first[out] + more[out] + NEAR, last) - 1
        low, more = windows(self._above[:, out], self._above[low, out], self._above[high, out])
        counts = self._inside(self.codes[out], low[:, None], more[:, None]).sum(axis=0, dtype=np.uint8)
        as_often = np.cumsum(np.bincount(counts, minlength=FIRST_LINES + 1)[::-1])[::-1]
        return np.flatnonzero(counts >= np.flatnonzero(as_often >= wanted)[-1])

    def colliding(self, codes: np.ndarray, at: np.ndarray, width: float) -> np.ndarray:
        """The rows of `codes` inside enough of the windows of half a `width` around `at`."""
        low, more = windows(self._above, at - width, at + width)
        counts = self._inside(codes, low, more).sum(axis=1, dtype=np.uint8)
        return np.flatnonzero(counts >= COLLISIONS * PROJECTIONS)

    def nearest(
        self, query_id: int, query: np.ndarray, k: int, budget: int, start: int
    ) -> tuple[np.ndarray, np.ndarray, int, int]:
        """The ids and inner products of the `k` best vectors found, best first.

        Then the step at which `budget` vectors collide, the first one wherever the search
        starts, and how many were verified.
        """
        at = (query / np.linalg.norm(query)) @ self.lines
        budget = min(budget, len(self.ids))
        codes, kept, keep = self._by_vector, None, max(LEAST_KEPT, KEPT * budget)
        if keep < len(self.ids):
            kept = self.first_round(at, keep)
            codes = codes[kept]
        step, found = start, self.colliding(codes, at, WIDTHS[start])
        while len(found) < budget:
            step += 1
            found = self.colliding(codes, at, WIDTHS[step])
        # What collides in narrower windows collides in these, so no other vector is counted.
        codes = codes[found]
        while step and len(fewer := self.colliding(codes, at, WIDTHS[step - 1])) >= budget:
            step, found, codes = step - 1, found[fewer], codes[fewer]
        found = found if kept is None else kept[found]
        verified = len(found)
        found = found[self.ids[found] != query_id]
        exact = (self.vectors[found].astype(float) * query).sum(axis=1)
        best = np.lexsort((self.ids[found], -exact))[:k]
        return self.ids[found[best]], exact[best], step, verified


def _index_block(block: pd.DataFrame, longest: float) -> pd.DataFrame:
    block = block.sort_values("vec_id", kind="stable")
    index = Index.build(block["vec_id"].to_numpy(), np.stack(block["vector"]), longest)
    return pd.DataFrame([{"dimension": block["dimension"].iloc[0], "wide": block["wide"].iloc[0]} | index.row()])


def _answer(blocks: pd.DataFrame, queries: pd.DataFrame, k: int, share: float) -> pd.DataFrame:
    """The answers of one block of vectors, to a block of queries."""
    out = {n: [] for n in ("query", "query_id", "vec_id", "score", "verified")}
    for row in blocks.to_dict("records"):
        index, step = Index.read(row), len(WIDTHS) * 3 // 4
        budget = k + 1 + int(share * len(index.ids))
        for query, query_id, vector in zip(queries["query"], queries["vec_id"], queries["vector"], strict=True):
            ids, scores, step, verified = index.nearest(query_id, vector.astype(float), k, budget, step)
            for name, value in (("query", query), ("query_id", query_id), ("verified", verified)):
                out[name].append(np.full(len(ids), value))
            out["vec_id"].append(ids)
            out["score"].append(scores)
    kinds = {n: float if n == "score" else np.int64 for n in out}
    return pd.DataFrame({n: np.concatenate([np.empty(0, kinds[n]), *v]) for n, v in out.items()})


def search(
    vectors: DataFrame,
    queries: Column,
    ws: Workspace,
    k: int = 20,
    block_vectors: int = BLOCK_VECTORS,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """The `k` nearest vectors that are found for each query, by largest inner product.

    `vectors` has ``vec_id`` and ``embedding``; `queries` is a condition that picks the
    rows that ask. Result: ``query_id``, ``rank`` from 1, ``vec_id``, ``score``; equal
    scores stand by smaller id. ``verified`` is how many vectors of the answer's block were
    verified for the query. Candidates are all rows but those with the query's id.
    Rows without an id, and vectors that are null, zero, or hold a null or a number that
    is not finite, take no part; vectors of different dimensions do not meet. Repeated
    rows count each as candidates, but equal ones ask once. An empty table gives an empty frame. Other columns are ignored.
    """
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("vector"),
        queries.alias("asks"),
        F.monotonically_increasing_id().alias("row"),
    ).where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    rows = rows.select(
        "vec_id",
        F.transform("vector", lambda x: x.cast("float")).alias("vector")
        if dict(vectors.dtypes)["embedding"] == "array<float>"
        else "vector",
        "asks",
        "row",
        F.size("vector").alias("dimension"),
    )
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x))
    table = ws.write(
        "vectors",
        rows,
        longest=F.max(length),
        asking=F.sum(F.col("asks").cast("bigint")),
    )
    wide = max(1, -(-table.rows // block_vectors))
    deep = max(1, -(-int(table.stats["asking"]) // block_queries))
    longest = float(table.stats["longest"]) or 1.0
    share = BUDGET / max(table.rows, 1) ** 0.5

    def block(count: int, of: str, name: str) -> Column:
        return F.pmod(F.xxhash64(of), F.lit(count)).alias(name)

    def each(count: int, name: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(count - 1).cast("bigint"))).alias(name)

    importable(ws.spark)
    indexed = table.df.select("vec_id", "vector", "dimension", block(wide, "row", "wide"))
    index = ws.write(
        "index",
        indexed.groupBy("dimension", "wide").applyInPandas(lambda b: _index_block(b, longest), INDEX),
    )
    # Equal rows ask once; rows that share an id only are told apart by the vector.
    asked = (
        table.df.where("asks")
        .select("vec_id", "vector", "dimension")
        .dropDuplicates(["vec_id", "vector"])
        .withColumn("query", F.xxhash64("vec_id", "vector"))
        .select("*", block(deep, "query", "deep"), each(wide, "wide"))
    )
    cell = ["dimension", "wide", "deep"]
    found = (
        index.df.select("*", each(deep, "deep"))
        .groupBy(*cell)
        .cogroup(asked.groupBy(*cell))
        .applyInPandas(lambda blocks, queries: _answer(blocks, queries, k, share), FOUND)
    )
    best = W.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score", "verified")
    )
