import itertools
from collections import Counter

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "3")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def baskets_frame(spark, baskets):
    """Lists of items as ``(tid, items)``, tid counting from 0."""
    return spark.createDataFrame(
        [(i, list(b)) for i, b in enumerate(baskets)], "tid BIGINT, items ARRAY<STRING>"
    )


def rows_frame(spark, baskets):
    """Lists of items as ``(tid, item)``; empty baskets leave no row."""
    return spark.createDataFrame(
        [(i, x) for i, b in enumerate(baskets) for x in b], "tid BIGINT, item STRING"
    )


def brute_force(baskets, min_support, max_len=None):
    """All frequent itemsets by plain enumeration."""
    counts = Counter()
    for basket in baskets:
        items = sorted({x for x in basket if x})
        longest = len(items) if max_len is None else min(max_len, len(items))
        for k in range(1, longest + 1):
            counts.update(itertools.combinations(items, k))
    return {s: n for s, n in counts.items() if n >= min_support}


def collected(itemsets):
    rows = itemsets.collect()
    found = {tuple(r["itemset"]): r["freq"] for r in rows}
    assert len(found) == len(rows), "an itemset came out twice"
    assert all(len(r["itemset"]) == r["k"] for r in rows)
    return found
