"""Neighbours against all inner products."""

import numpy as np
from pyspark.sql import functions as F

from basketweave.llm import neighbours
from tests.llm.conftest import with_clashes

VECTOR = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT"


def frame(spark, vectors):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in vectors]
    return spark.createDataFrame(rows, VECTOR)


def brute_force(vectors, k, asks):
    ids = np.array([i for i, _ in vectors])
    data = np.array([v for _, v in vectors], np.float32).astype(float)
    out = {}
    for i in np.flatnonzero([asks(i) for i in ids]):
        scores = (data * data[i]).sum(axis=1)
        order = [j for j in np.lexsort((ids, -scores)) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), scores[j]) for j in order]
    return out


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))  # one query for each id
        assert len(out[r["query_id"]]) == r["rank"]
    return out


def test_recall_over_blocks(spark, ws):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((8, 24))
    data = centres[rng.integers(0, 8, 3000)] + 0.4 * rng.standard_normal((3000, 24))
    data[1500:] = rng.standard_normal((1500, 24)) * rng.uniform(0.5, 2, (1500, 1))
    vectors = list(enumerate(data))
    found = answers(
        neighbours.search(
            frame(spark, vectors), F.col("vec_id") % 50 == 0, ws, 20, block_vectors=800, block_queries=25
        )
    )
    best = brute_force(vectors, 20, lambda i: i % 50 == 0)
    assert found.keys() == best.keys()
    hits = [len({i for i, _ in found[q]} & {i for i, _ in best[q]}) / 20 for q in best]
    assert np.mean(hits) >= 0.9
    for q, near in found.items():
        query = np.float32(data[q]).astype(float)
        for i, score in near:
            assert abs(score - (np.float32(data[i]).astype(float) * query).sum()) < 1e-12
        assert near == sorted(near, key=lambda x: (-x[1], x[0]))


def test_odd_rows_and_ties(spark, ws):
    same = [1.0, 2.0, 0.0]
    rows = [(i, same) for i in range(40)] + [(50, [2.0, 4.0, 0.0])]
    odd = [
        (60, None), (80, [0.0, 0.0, 0.0]), (100, [1.0, None, 2.0]), (120, [float("nan"), 1.0, 1.0]),
        (140, [float("inf"), 1.0, 1.0]), (160, [1.0, 2.0]), (None, same), (180, []),
    ]
    table = with_clashes(frame(spark, rows + odd))
    found = answers(neighbours.search(table, F.col("vec_id") % 20 == 0, ws, 5))
    assert found[0] == [(50, 10.0), *((i, 5.0) for i in (1, 2, 3, 4))]
    assert found[20] == [(50, 10.0), *((i, 5.0) for i in (0, 1, 2, 3))]
    assert set(found) == {0, 20}
    few = answers(neighbours.search(frame(spark, rows[:3]), F.col("vec_id") == 1, ws, 5))
    assert few == {1: [(0, 5.0), (2, 5.0)]}
    assert neighbours.search(table.limit(0), F.col("vec_id") == 0, ws).collect() == []


def test_repeated_queries_ask_once(spark, ws):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0])] + [(i, [1.0, i / 10]) for i in range(1, 6)]
    found = answers(neighbours.search(frame(spark, rows), F.col("vec_id") == 0, ws, 4))
    assert [i for i, _ in found[0]] == [1, 2, 3, 4]
    twice = rows + [(3, [1.0, 0.3])]
    found = answers(neighbours.search(frame(spark, twice), F.col("vec_id") == 0, ws, 4))
    assert [i for i, _ in found[0]] == [1, 2, 3, 3]


def test_the_share_that_is_verified_falls(spark, ws):
    """Weak neighbours in 64 dimensions; the budget follows the root of the table."""
    shares = []
    for n in (1000, 6000):
        data = np.random.default_rng(n).standard_normal((n, 64))
        data /= np.linalg.norm(data, axis=1, keepdims=True)
        vectors = list(enumerate(data))
        asks = F.col("vec_id") % 50 == 0
        whole = neighbours.search(frame(spark, vectors), asks, ws, 20, block_vectors=n)
        shares.append(whole.agg(F.avg("verified")).first()[0] / n)
        best = brute_force(vectors, 20, lambda i: i % 50 == 0)
        found = answers(whole)
        assert np.mean([len({i for i, _ in found[q]} & {i for i, _ in best[q]}) / 20 for q in best]) >= 0.85
    assert shares[0] < 0.35 and shares[1] < 0.12 and shares[1] < shares[0] / 2


def test_the_step_does_not_depend_on_the_start():
    rng = np.random.default_rng(2)
    data = rng.standard_normal((500, 16))
    index = neighbours.Index.build(np.arange(500), data, float(np.linalg.norm(data, axis=1).max()))
    again = neighbours.Index.read(index.row())
    for start in (0, 60, len(neighbours.WIDTHS) - 1):
        for i in (3, 77):
            a, b = (x.nearest(i, data[i], 5, 60, s) for x, s in ((index, start), (again, 30)))
            assert a[0].tolist() == b[0].tolist() and a[2:] == b[2:] and a[3] >= 60


class Counting(neighbours.Index):
    """An index that adds up how many codes its queries look at."""

    seen = 0

    def _inside(self, codes, low, more):
        self.seen += codes.size
        return super()._inside(codes, low, more)


def test_a_large_block_is_counted_on_few_lines_first():
    """Vectors of one cloud and of many lengths: what is near is found, and little is looked at."""
    n, k, rng = 8000, 20, np.random.default_rng(11)
    data = rng.standard_normal((n, 48)) + rng.standard_normal(48)
    data *= rng.uniform(0.7, 1.3, (n, 1))
    index = Counting.build(np.arange(n), data, float(np.linalg.norm(data, axis=1).max()))
    budget, step, hits = 200, 60, []
    for i in range(0, n, 100):
        near, scores, step, verified = index.nearest(i, data[i], k, budget, step)
        exact = data @ data[i]
        exact[i] = -np.inf
        hits.append(len(set(near.tolist()) & set(np.argsort(-exact)[:k].tolist())) / k)
        assert budget <= verified and np.allclose(scores, exact[near])
    assert np.mean(hits) >= 0.9
    # All vectors on the first lines, and less in all than one look at all windows.
    assert n * neighbours.FIRST_LINES <= index.seen / len(hits) < 0.75 * n * neighbours.PROJECTIONS


def test_copies_in_a_large_block_stand_by_id():
    """More copies of a query than the first round keeps, and than its buckets hold."""
    rng = np.random.default_rng(5)
    data = rng.standard_normal((6000, 16))
    data[1000:5500] = data[0]
    data[5500] = 2 * data[0]
    index = neighbours.Index.build(np.arange(6000), data, float(np.linalg.norm(data, axis=1).max()))
    near, _, _, verified = index.nearest(5000, data[5000], 5, 100, 60)
    assert near.tolist() == [5500, 0, 1000, 1001, 1002] and verified > 4500
