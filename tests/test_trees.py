"""The prefix tree and its cells against plain dictionaries."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import basketweave as bw
from basketweave.functions import arrays
from basketweave.operators import prefix_tree, tree_paths
from basketweave.operators.trees import tree_cells

SCHEMA = "prefix ARRAY<INT>, w BIGINT"


def merged(spark, seed=2, n=80):
    rng = random.Random(seed)
    counts = Counter(tuple(sorted(rng.sample(range(9), rng.randint(0, 6)))) for _ in range(n))
    return spark.createDataFrame([(list(p), w) for p, w in counts.items()], SCHEMA), counts


def expected(counts):
    nodes = Counter()
    for path, w in counts.items():
        nodes.update({path[:i]: w for i in range(1, len(path) + 1)})
    return dict(nodes)


@pytest.mark.parametrize("width", [None, 6, 5000])
def test_tree_of_all_prefixes(spark, monkeypatch, width):
    monkeypatch.setattr(arrays, "WIDE_ROW", 2 if width == 6 else 1024)
    baskets, counts = merged(spark)
    tree = prefix_tree(baskets, width)
    rows = tree.join(tree_paths(tree).select("node", "path"), "node").collect()
    assert {tuple(r["path"]): r["w"] for r in rows} == expected(counts)
    names = {tuple(r["path"]): r["node"] for r in rows}
    assert len(set(names.values())) == len(names)
    for r in rows:
        path = tuple(r["path"])
        assert r["item"] == path[-1] and r["depth"] == len(path)
        assert r["parent"] == (names[path[:-1]] if len(path) > 1 else None)


def test_cells_find_their_ancestors(spark):
    baskets, counts = merged(spark, 3)
    ws = bw.Workspace(spark)
    table = ws.write("baskets", baskets, width=F.max(F.size("prefix")))
    lines, cells = tree_cells(ws, table)
    line = {r["b"]: (r["prefix"], r["places"]) for r in lines.df.collect()}
    seen, at = {}, {}
    for r in cells.df.collect():
        prefix, places = line[r["b"]]
        assert prefix[r["pos"]] == r["item"] and places[r["pos"]] == r["b"]
        seen[tuple(prefix[: r["pos"] + 1])] = r["w"]
        at[r["b"], r["pos"]] = tuple(prefix[: r["pos"] + 1])
    assert seen == expected(counts)
    for b, pos in at:
        prefix, places = line[b]
        for i in range(pos):  # an ancestor's place is a cell of the same path
            assert at[places[i], i] == tuple(prefix[: i + 1])


def test_empty_baskets_and_tables(spark):
    for rows in ([], [([], 3)]):
        tree = prefix_tree(spark.createDataFrame(rows, SCHEMA))
        assert tree.collect() == [] and tree_paths(tree).collect() == []


def test_paths_past_the_broadcast(spark, monkeypatch):
    from basketweave.functions import joins

    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    baskets, counts = merged(spark, 4)
    tree = prefix_tree(baskets)
    assert {tuple(r["path"]): r["w"] for r in tree_paths(tree).collect()} == expected(counts)
