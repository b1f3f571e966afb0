"""The triangular matrix against pairs counted one by one."""

import itertools
import random
from collections import Counter
from types import SimpleNamespace

import pytest

from basketweave.functions import arrays
from basketweave.operators import matrix_pairs, pair_matrix
from basketweave.operators.patterns import count_pairs, pattern_base
from basketweave.workspace import checkpoint_root

SCHEMA = "prefix ARRAY<INT>, w BIGINT"


def merged(spark, items, n=60, seed=3):
    rng = random.Random(seed)
    counts = Counter(tuple(sorted(rng.sample(range(items), rng.randint(0, min(items, 40))))) for _ in range(n))
    return spark.createDataFrame([(list(p), 3 * w) for p, w in counts.items()], SCHEMA), counts


@pytest.mark.parametrize("items, cut", [(5, 1024), (33, 1024), (150, 16)])
def test_cells_are_the_pair_counts(spark, monkeypatch, items, cut):
    monkeypatch.setattr(arrays, "WIDE_ROW", cut)
    baskets, counts = merged(spark, items)
    want = Counter()
    for basket, w in counts.items():
        want.update({pair: 3 * w for pair in itertools.combinations(basket, 2)})
    for least in (1, 9):
        rows = matrix_pairs(pair_matrix(baskets, 40), least).collect()
        assert {(r["left"], r["right"]): r["freq"] for r in rows} == {p: n for p, n in want.items() if n >= least}


def test_fewer_rows_than_pairs(spark):
    baskets, _ = merged(spark, 120, 200)
    blocks = pair_matrix(baskets).count()
    pairs = count_pairs(pattern_base(baskets), 1).count()
    assert blocks * 20 < pairs


def test_no_pairs(spark):
    for rows in ([], [([], 1)], [([4], 2)]):
        assert pair_matrix(spark.createDataFrame(rows, SCHEMA)).collect() == []


@pytest.mark.parametrize(
    "master, warehouse, refused",
    [
        ("local[4]", "file:/tmp/w", False),
        ("local", "spark-warehouse", False),
        ("yarn", "file:/tmp/w", True),
        ("yarn", "/tmp/w", True),
        ("spark://h:7077", "spark-warehouse", True),
        ("local-cluster[2,1,1024]", "file:///tmp/w", True),
        ("yarn", "hdfs://n/w", False),
        ("yarn", "s3a://b/w", False),
    ],
)
def test_intermediate_tables_are_shared(master, warehouse, refused):
    spark = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, *_: None if "checkpoint" in key else warehouse),
        sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: None),
    )
    if refused:
        with pytest.raises(ValueError):
            checkpoint_root(spark)
    else:
        assert checkpoint_root(spark).startswith(warehouse)
