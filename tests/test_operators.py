"""The building blocks, against brute force on small data."""

import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import basketweave as bw
from basketweave import operators as ops
from basketweave import workspace
from basketweave.functions import arrays, expand_positions, lookup_join, subsets, without_each
from basketweave.functions import joins
from basketweave.workspace import Workspace, checkpoint_root
from tests.conftest import baskets_frame, brute_force, rows_frame
from tests.data import DEMO, DEMO_RULES


@pytest.fixture(scope="module")
def baskets():
    rng = random.Random(20)
    return [rng.choices("abcdefg", k=rng.randint(1, 7)) for _ in range(50)]


def as_dict(df, *keys, value):
    def key(row):
        return tuple(tuple(row[k]) if isinstance(row[k], list) else row[k] for k in keys)

    return {key(r): r[value] for r in df.collect()}


def ranked(baskets, min_support):
    counts = brute_force(baskets, min_support, 1)
    order = sorted(counts, key=lambda s: (-counts[s], s))
    return {s[0]: i for i, s in enumerate(order)}


def coded(baskets, min_support):
    rank = ranked(baskets, min_support)
    return [sorted({rank[x] for x in b if x in rank}) for b in baskets]


def test_counts_and_ranks(spark, baskets):
    rows = rows_frame(spark, baskets)
    counts = as_dict(ops.item_counts(rows), "item", value="freq")
    assert counts == brute_force(baskets, 1, 1)
    frequent = ops.frequent_items(rows, 20)
    assert as_dict(frequent, "item", value="freq") == brute_force(baskets, 20, 1)
    expected = {(x,): i for x, i in ranked(baskets, 1).items()}
    items = ops.item_counts(rows)
    assert as_dict(ops.item_rank(items), "item", value="rk") == expected
    assert as_dict(ops.item_rank(items, Workspace(spark)), "item", value="rk") == expected


def test_prune_and_compress(spark, baskets):
    rows = rows_frame(spark, baskets)
    rank = ops.item_rank(ops.frequent_items(rows, 22))
    pruned = ops.prune_transactions(rows, rank)
    expected = {(i,): b for i, b in enumerate(coded(baskets, 22)) if b}
    assert as_dict(pruned, "tid", value="items") == expected
    merged = as_dict(ops.compress_transactions(pruned), "prefix", value="w")
    assert merged == Counter((tuple(b),) for b in expected.values())


def test_conditional_transactions(spark, baskets):
    codes = [b for b in coded(baskets, 1) if b]
    pruned = spark.createDataFrame(list(enumerate(codes)), "tid BIGINT, items ARRAY<INT>")
    for groups in (1, 3, 10):
        found = as_dict(ops.conditional_transactions(pruned, groups), "tid", "grp", value="prefix")
        expected = {}
        for tid, b in enumerate(codes):
            for i, x in enumerate(b):
                expected[tid, x % groups] = b[: i + 1]
        assert found == expected


def test_pattern_base_counts_and_projection(spark, baskets):
    codes = [b for b in coded(baskets, 1) if b]
    frame = spark.createDataFrame([(b, 1) for b in codes], "prefix ARRAY<INT>, w BIGINT")
    base = ops.conditional_pattern_base(ops.pattern_base(frame), keep_empty=True)
    expected = Counter(((x,), tuple(b[:i])) for b in codes for i, x in enumerate(b))
    assert as_dict(base, "suffix", "prefix", value="w") == expected

    counts = Counter()
    for (suffix, prefix), w in expected.items():
        for x in prefix:
            counts[suffix, x] += w
    kept = {key: n for key, n in counts.items() if n >= 8}
    items = ops.conditional_item_counts(base, 8)
    assert as_dict(items, "suffix", "item", value="freq") == kept

    projected = ops.project_prefixes(base, ops.kept_items(items))
    total = Counter()
    for r in projected.collect():
        total[tuple(r["suffix"]), tuple(r["prefix"])] += r["w"]
    wanted = Counter()
    for (suffix, prefix), w in expected.items():
        rest = tuple(x for x in prefix if (suffix, x) in kept)
        if rest:
            wanted[suffix, rest] += w
    assert total == wanted


@pytest.mark.parametrize("min_support", [1, 9])
def test_pair_counts(spark, baskets, min_support):
    expected = {s: n for s, n in brute_force(baskets, min_support, 2).items() if len(s) == 2}
    for data in (rows_frame(spark, baskets), baskets_frame(spark, baskets)):
        found = as_dict(ops.pair_counts(data, min_support), "item_a", "item_b", value="freq")
        assert found == expected


@pytest.mark.parametrize("block", [1, 2, 5000])
def test_candidates(spark, baskets, monkeypatch, block):
    from basketweave.operators import candidates

    monkeypatch.setattr(candidates, "PAIR_BLOCK", block)
    for k, min_support in ((2, 1), (3, 9), (4, 4)):
        level = {s for s in brute_force(baskets, min_support, k - 1) if len(s) == k - 1}
        frame = spark.createDataFrame([(list(s),) for s in level], "itemset ARRAY<STRING>")
        items = sorted({x for s in level for x in s})
        joined = {
            c
            for c in itertools.combinations(items, k)
            if c[:-1] in level and c[:-2] + c[-1:] in level
        }
        pruned = {c for c in joined if all(s in level for s in itertools.combinations(c, k - 1))}
        found = ops.generate_candidates(frame)
        rows = [tuple(r["itemset"]) for r in found.collect()]
        assert set(rows) == joined and len(rows) == len(joined)
        kept = ops.prune_candidates(found, frame).collect()
        assert {tuple(r["itemset"]) for r in kept} == pruned


def test_candidate_counts(spark, baskets):
    merged = Counter(tuple(sorted(set(b))) for b in baskets)
    held = spark.createDataFrame(
        [([], list(b), n) for b, n in merged.items()],
        "itemset ARRAY<STRING>, rest ARRAY<STRING>, w BIGINT",
    )
    for _ in range(2):
        held = ops.extend_occurrences(held)
    wanted = [("a", "b", "c"), ("b", "d", "f"), ("a", "b", "z")]
    frame = spark.createDataFrame([(list(s),) for s in wanted], "itemset ARRAY<STRING>")
    expected = {(s,): n for s, n in brute_force(baskets, 1, 3).items() if s in wanted}
    for rows in (None, 3):
        found = ops.count_candidates(held, frame, candidate_rows=rows, k=3)
        assert as_dict(found, "itemset", value="freq") == expected


def test_tid_lists(spark, baskets):
    rows = rows_frame(spark, baskets)
    lists = ops.tid_lists(rows, 15, buckets=4)
    held = {}
    for r in lists.collect():
        held.setdefault(tuple(r["itemset"]), []).extend(r["tids"])
    frequent = brute_force(baskets, 15, 1)
    assert {s: sorted(t) for s, t in held.items()} == {
        s: [i for i, b in enumerate(baskets) if s[0] in b] for s in frequent
    }
    level = spark.createDataFrame([(list(s),) for s in frequent], "itemset ARRAY<STRING>")
    pairs = ops.generate_candidates(level)
    for rows in (None, 100):
        met = ops.tid_list_sizes(ops.intersect_tid_lists(lists, pairs, rows))
        expected = brute_force([[x for x in b if (x,) in frequent] for b in baskets], 1, 2)
        assert as_dict(met, "itemset", value="freq") == {
            (s,): n for s, n in expected.items() if len(s) == 2
        }


def test_demo_rules(spark):
    data = baskets_frame(spark, [line.split() for line in DEMO])
    n = bw.transaction_count(data)
    found = bw.frequent_itemsets(data, 2, "builtin")
    rules = bw.association_rules(found, n).collect()
    shown = [
        (tuple(r[0]), r[1], *[round(x, 6) for x in r[2:]])
        for r in rules
    ]
    assert sorted(shown) == sorted(DEMO_RULES)
    sure = bw.association_rules(found, n, min_confidence=0.75, lift=True).collect()
    assert {(tuple(r["antecedent"]), r["consequent"]) for r in sure} == {
        (x[0], x[1]) for x in DEMO_RULES if x[5] >= 0.75
    }
    own = {(tuple(r["antecedent"]), r["consequent"]): round(r["lift"], 6) for r in sure}
    other = bw.association_rules_builtin(data, 2, min_confidence=0.75).collect()
    assert own == {(tuple(r["antecedent"]), r["consequent"][0]): round(r["lift"], 6) for r in other}


def test_builtin_rules_without_itemsets(spark):
    rules = bw.association_rules_builtin(baskets_frame(spark, [["a"]]), 2)
    assert rules.collect() == [] and "lift" in rules.columns


def test_subset_expressions(spark):
    one = spark.createDataFrame([([1, 2, 3],)], "x ARRAY<INT>")
    everything = one.select(subsets(F.col("x"))).collect()[0][0]
    assert sorted(everything) == [[], [1], [1, 2], [1, 2, 3], [1, 3], [2], [2, 3], [3]]
    short = one.select(subsets(F.col("x"), 1)).collect()[0][0]
    assert sorted(short) == [[], [1], [2], [3]]
    assert one.select(without_each(F.col("x"))).collect()[0][0] == [[2, 3], [1, 3], [1, 2]]


def test_wide_rows_are_cut(spark, monkeypatch):
    monkeypatch.setattr(arrays, "WIDE_ROW", 4)
    data = [(i, list(range(n))) for i, n in enumerate((0, 1, 4, 5, 8, 11))]
    frame = spark.createDataFrame(data, "id INT, x ARRAY<INT>")
    expected = sorted((i, p, x) for i, xs in data for p, x in enumerate(xs))
    for width in (None, 11):
        found = expand_positions(frame, "x", width).collect()
        assert sorted((r["id"], r["pos"], r["item"]) for r in found) == expected


@pytest.mark.parametrize("how", ["inner", "left_semi"])
def test_lookup_join_with_a_hot_key(spark, monkeypatch, how):
    big = spark.range(300).select(
        F.when(F.col("id") < 200, "hot")
        .otherwise(F.concat(F.lit("k"), F.col("id") % 50))
        .alias("key"),
        "id",
    )
    keys = [("hot", 1), ("k3", 2), ("none", 3)]
    small = spark.createDataFrame(keys, "key STRING, v INT")
    if how == "left_semi":
        small = small.select("key")
    expected = sorted(tuple(r) for r in big.join(small, "key", how).collect())
    for limit in (0, joins.BROADCAST_BYTES):
        monkeypatch.setattr(joins, "BROADCAST_BYTES", limit)
        found = lookup_join(big, small, "key", 3, 100, ["id"], how)
        assert sorted(tuple(r) for r in found.collect()) == expected


def test_hot_key_is_spread_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    big = spark.range(300).select(F.lit("hot").alias("key"), "id")
    small = spark.createDataFrame([("hot", 1)], "key STRING, v INT")
    found = lookup_join(big, small, "key", 1, 100, ["id"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in plan and plan.count("Range (") == 1
    assert found.count() == 300


def test_a_side_with_small_files_is_not_broadcast(spark, tmp_path):
    """Spark would take a few KB of files for a small side, whatever comes out of its rows."""
    spark.range(20).select(F.sequence(F.lit(1), F.lit(5000)).alias("x")).write.parquet(f"{tmp_path}/big")
    big = spark.read.parquet(f"{tmp_path}/big").select(F.explode("x").alias("key"))
    small = spark.range(3).withColumnRenamed("id", "key")
    found = lookup_join(big, small, "key", 10**7, 100, ["key"])
    assert "BroadcastHashJoin" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 40


def test_long_keep_arrays_prune(spark):
    kept = list(range(1, 5001))
    base = spark.createDataFrame(
        [([7], [1, 2, 999_999], 1), ([7], [888_888], 2)], "suffix ARRAY<INT>, prefix ARRAY<INT>, w BIGINT"
    )
    keep = spark.createDataFrame([([7], kept)], "suffix ARRAY<INT>, keep ARRAY<INT>")
    assert [r["prefix"] for r in ops.project_prefixes(base, keep).collect()] == [[1, 2]]


def test_wide_rows_are_read_once_and_cut(spark):
    frame = spark.range(1).select(F.sequence(F.lit(0), F.lit(4999)).alias("x"))
    found = expand_positions(frame, "x", 5000)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1 and "RoundRobin" not in plan
    assert sorted((r["pos"], r["item"]) for r in found.select("pos", "item").collect()) == [
        (i, i) for i in range(5000)
    ]


def test_ranking_has_no_window_over_items(spark):
    items = spark.createDataFrame([("a", 2), ("b", 2), ("c", 3)], "item STRING, freq BIGINT")
    ranked = ops.item_rank(items)
    assert {r["item"]: r["rk"] for r in ranked.collect()} == {"c": 0, "a": 1, "b": 2}
    assert "Window" not in ranked._jdf.queryExecution().executedPlan().toString()


def test_no_plan_has_a_cross_join(spark, baskets):
    rows = rows_frame(spark, baskets)
    level = ops.frequent_items(rows, 2).select(F.array("item").alias("itemset"), "freq")
    n = bw.transaction_count(rows)
    found = level.withColumn("k", F.size("itemset"))
    for frame in (
        ops.generate_candidates(level),
        ops.prune_candidates(ops.generate_candidates(level), level),
        ops.pair_counts(rows),
        ops.intersect_tid_lists(ops.tid_lists(rows, 2, 3), ops.generate_candidates(level)),
        bw.itemset_support(found, n),
        bw.association_rules(found, n),
    ):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_workspace(spark):
    ws = Workspace(spark)
    assert checkpoint_root(spark) in ws.path
    table = ws.write("numbers", spark.range(10), biggest=F.max("id"))
    assert (table.rows, table.stats) == (10, {"biggest": 9})
    assert table.df.count() == 10
    empty = ws.write("numbers", spark.range(0), biggest=F.max("id"))
    assert (empty.rows, empty.stats) == (0, {"biggest": 0})
    assert empty.df.collect() == []
    ws.drop(table)
    with pytest.raises(Exception):
        spark.read.parquet(table.path)
    ws.close()
    with pytest.raises(Exception):
        spark.read.parquet(empty.path)


def test_workspace_as_a_context_leaves_nothing(spark):
    with Workspace(spark) as ws:
        path = ws.write("numbers", spark.range(3)).path
        assert spark.read.parquet(path).count() == 3
    with pytest.raises(Exception):
        spark.read.parquet(path)


def test_a_lost_metric_raises():
    class Lost:
        get = {"rows": 3}

    assert workspace._measured(Lost, ["rows"]) == {"rows": 3}
    with pytest.raises(RuntimeError):
        workspace._measured(Lost, ["rows", "width"])
