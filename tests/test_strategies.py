"""All strategies against known answers, brute force and each other."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import basketweave as bw
from basketweave.functions import joins
from basketweave.operators import patterns
from basketweave.plans import builtin, growth
from tests.conftest import baskets_frame, brute_force, collected, rows_frame
from tests.data import DEMO, DEMO_ITEMSETS, LETTER_SIZES

ALGORITHMS = bw.ALGORITHMS


def random_baskets(seed, n=60, items="abcdefghij"):
    rng = random.Random(seed)
    return [rng.choices(items, k=rng.randint(0, 8)) for _ in range(n)]


@pytest.mark.parametrize("algorithm", ALGORITHMS)
def test_demo(spark, algorithm):
    data = baskets_frame(spark, [line.split() for line in DEMO])
    assert collected(bw.frequent_itemsets(data, 2, algorithm)) == DEMO_ITEMSETS


@pytest.mark.parametrize("lines,min_support,sizes", LETTER_SIZES)
def test_letter_files(spark, tmp_path, lines, min_support, sizes):
    (tmp_path / "in.txt").write_text("\n".join(lines) + "\n")
    data = bw.read_transactions(spark, str(tmp_path / "in.txt"), delimiter=",")
    found = collected(bw.frequent_itemsets(data, min_support, "pair_pruned"))
    assert Counter(len(s) for s in found) == sizes
    assert found == brute_force([line.split(",") for line in lines], min_support)


@pytest.mark.parametrize("algorithm", ALGORITHMS)
def test_random_baskets(spark, algorithm):
    baskets = random_baskets(1)
    found = bw.frequent_itemsets(rows_frame(spark, baskets), 3, algorithm)
    assert collected(found) == brute_force(baskets, 3)


@pytest.mark.parametrize(
    "algorithm,max_len", [(a, n) for a in ALGORITHMS for n in (2, 3)] + [("pair_pruned", 1)]
)
def test_max_len(spark, algorithm, max_len):
    baskets = random_baskets(3)
    found = bw.frequent_itemsets(rows_frame(spark, baskets), 4, algorithm, max_len=max_len)
    assert collected(found) == brute_force(baskets, 4, max_len)


@pytest.mark.parametrize("algorithm", ALGORITHMS)
def test_nothing_frequent_and_empty_input(spark, algorithm):
    for baskets, min_support in (([["a"], ["b"]], 3), ([], 1)):
        none = bw.frequent_itemsets(baskets_frame(spark, baskets), min_support, algorithm)
        assert none.collect() == []
        assert none.dtypes == [("itemset", "array<string>"), ("k", "int"), ("freq", "bigint")]


@pytest.mark.parametrize("algorithm", ALGORITHMS)
def test_equal_baskets_duplicates_and_blanks(spark, algorithm):
    baskets = [["a", "b", "c", "a"]] * 6 + [[], ["", "a"]]
    found = collected(bw.frequent_itemsets(baskets_frame(spark, baskets), 6, algorithm))
    assert found == brute_force(baskets, 6)
    assert found[("a", "b", "c")] == 6 and found[("a",)] == 7


@pytest.mark.parametrize(
    "algorithm", ["apriori", "eclat", "pair_pruned", "prefix_array", "cells", "fpgrowth"]
)
def test_single_items_only(spark, algorithm):
    found = collected(bw.frequent_itemsets(baskets_frame(spark, [["a"], ["a"], ["b"]]), 1, algorithm))
    assert found == {("a",): 2, ("b",): 1}


@pytest.mark.parametrize("algorithm", ALGORITHMS)
def test_one_basket_holds_a_third_of_all_rows(spark, algorithm):
    rng = random.Random(7)
    wide = [f"i{n:03d}" for n in range(120)]
    baskets = [wide] + [rng.sample(wide, 4) for _ in range(60)]
    found = bw.frequent_itemsets(rows_frame(spark, baskets), 4, algorithm)
    # Every itemset of the other baskets is in the wide one too.
    expected = {s: n + 1 for s, n in brute_force(baskets[1:], 3).items()}
    assert collected(found) == expected


@pytest.mark.parametrize("algorithm", ["fpgrowth", "builtin"])
@pytest.mark.parametrize("groups", [1, 4, 36])
def test_groups_do_not_matter(spark, algorithm, groups):
    baskets = random_baskets(4)
    found = bw.frequent_itemsets(rows_frame(spark, baskets), 5, algorithm, num_groups=groups)
    assert collected(found) == brute_force(baskets, 5)


@pytest.mark.parametrize("width", [None, 2, 100])
@pytest.mark.parametrize(
    "mine", [growth.mine_prefix_array, growth.mine_fpgrowth, growth.mine_pair_pruned]
)
def test_rounds_and_direct_counting_agree(spark, mine, width):
    baskets = random_baskets(5, n=80)
    found = mine(bw.Workspace(spark), rows_frame(spark, baskets), 3, finish_width=width)
    assert collected(found) == brute_force(baskets, 3)


@pytest.mark.parametrize("algorithm", ["fpgrowth", "pair_pruned", "prefix_array", "cells"])
def test_growth_strategies_run_their_own_rounds(spark, monkeypatch, algorithm):
    written = []
    for way in ("write", "write_bucketed"):
        monkeypatch.setattr(
            bw.Workspace,
            way,
            lambda ws, name, *a, write=getattr(bw.Workspace, way), **k: written.append(name)
            or write(ws, name, *a, **k),
        )
    baskets = [list("abcdef")] * 3 + [list("abc")] * 2
    found = collected(bw.frequent_itemsets(rows_frame(spark, baskets), 3, algorithm))
    assert max(map(len, found)) == 6 and found == brute_force(baskets, 3)
    assert "direct" not in written
    rounds = {"pair_pruned": "pairs", "fpgrowth": "base"}.get(algorithm, "counts")
    assert written.count(rounds) >= 5


def test_groups_grow_where_they_are(spark):
    """From the second round on nothing is shuffled, joined or broadcast."""
    ws = bw.Workspace(spark)
    baskets = [sorted(b) for b in random_baskets(12)]
    ranked = spark.createDataFrame(
        [([ord(x) - 97 for x in sorted(set(b) - {""})], 1) for b in baskets], "prefix ARRAY<INT>, w BIGINT"
    )
    sharded = growth.conditional_transactions(ranked, 5, array="prefix").withColumn(
        "suffix", F.array().cast("array<int>")
    )
    owner = F.col("item") % 5 == F.col("grp")
    first = growth.grow_in_group(sharded.repartition(3, "grp"), 1, owner)
    base = ws.write_bucketed("base", first, "grp", 3)
    again = growth.grow_in_group(base.df, 2)
    plan = again._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "Window" in plan
    counts = base.df.groupBy("grp", "suffix").agg(F.sum("w"))
    assert "Exchange" not in counts._jdf.queryExecution().executedPlan().toString()
    assert base.df.select("grp").distinct().count() == 5
    (table,) = ws._catalogued.values()
    ws.close()
    assert not spark.catalog.tableExists(table)


@pytest.mark.parametrize("groups, width, limit", [(2, 2, None), (1, None, 0), (2, None, 3)])
def test_a_large_group_is_dealt_to_pieces(spark, monkeypatch, groups, width, limit):
    monkeypatch.setattr(growth, "GROUP_BASKETS", 10)
    if limit == 0:  # nothing is broadcast
        monkeypatch.setattr(growth, "fits_broadcast", lambda *_: False)
        monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    tables = []
    write = bw.Workspace.write_bucketed

    def counted(ws, name, df, key, buckets, **metrics):
        table = write(ws, name, df, key, buckets, **metrics)
        tables.append(len(table.df.inputFiles()))
        return table

    monkeypatch.setattr(bw.Workspace, "write_bucketed", counted)
    baskets = random_baskets(31, n=90)
    found = growth.mine_fpgrowth(bw.Workspace(spark), rows_frame(spark, baskets), 3, limit or None, groups, width)
    assert collected(found) == brute_force(baskets, 3, limit or None)
    assert tables[0] > groups and max(tables) <= 9 * groups


def test_local_order_merges_more(spark):
    """Items that are rare in all but frequent with a suffix come first there."""
    rng = random.Random(21)
    baskets = []
    for _ in range(400):  # with item 9 the rare items are common, and the common ones rare
        inner = [i for i in range(9) if rng.random() < (0.9 if i > 5 else 0.3)]
        baskets.append((inner + [9], 1))
    base = spark.createDataFrame([([9], b[:-1], w) for b, w in baskets], "suffix ARRAY<INT>, prefix ARRAY<INT>, w BIGINT")
    keep = patterns.kept_items(growth.extension_counts(base, 5).select("suffix", "item", "freq"))
    rows, itemsets = {}, {}
    for local in (False, True):
        longer = growth.conditional_pattern_base(growth.project_prefixes(base, keep, local_order=local))
        rows[local] = longer.count()
        itemsets[local] = {
            (frozenset(r["suffix"]) | {r["item"]}): r["freq"] for r in growth.extension_counts(longer, 5).collect()
        }
    assert rows[True] < 0.9 * rows[False]
    assert itemsets[True] == itemsets[False] and len(itemsets[True]) > 30


@pytest.mark.parametrize("long_rows, joins_used", [(1, "broadcast"), (40, "shuffle")])
def test_size_of_kept_items_decides_the_join(spark, monkeypatch, long_rows, joins_used):
    """Suffixes that keep one item must not hide the size of a few long ones."""
    from basketweave.functions import joins

    asked = []
    fits = joins.fits_broadcast
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 6_000)
    monkeypatch.setattr(
        joins, "fits_broadcast", lambda rows, size: asked.append(fits(rows, size)) or asked[-1]
    )
    items = [f"{i:03d}" for i in range(long_rows + 1)]
    baskets = [items] * 2 + [[f"x{i}", f"y{i}"] for i in range(400) for _ in range(2)]
    data = rows_frame(spark, baskets)
    ws = bw.Workspace(spark)
    base_of = growth.rank_dictionary(ws, data, 2)
    encoded = growth.encode_baskets(ws, data, base_of)
    base = growth._write_base(
        ws, growth.conditional_pattern_base(growth.pattern_base(encoded.df), encoded.stats["width"])
    )
    asked.clear()
    growth.grow(ws, base, 1, 2, max_len=3)
    assert (False in asked) == (joins_used == "shuffle")


@pytest.mark.parametrize("width", [1, 4])
def test_subsets_of_wide_baskets_grow_first(spark, width):
    baskets = random_baskets(6)
    found = growth.mine_subsets(
        bw.Workspace(spark), rows_frame(spark, baskets), 3, subset_width=width
    )
    assert collected(found) == brute_force(baskets, 3)


@pytest.mark.parametrize("buckets", [1, 8])
def test_tid_buckets_do_not_matter(spark, buckets):
    from basketweave.plans import mine_eclat

    baskets = random_baskets(8)
    found = mine_eclat(bw.Workspace(spark), rows_frame(spark, baskets), 3, buckets=buckets)
    assert collected(found) == brute_force(baskets, 3)


def test_downward_closure_and_thresholds(spark):
    baskets = random_baskets(9)
    low = collected(bw.frequent_itemsets(rows_frame(spark, baskets), 3))
    high = collected(bw.frequent_itemsets(rows_frame(spark, baskets), 6))
    assert high == {s: n for s, n in low.items() if n >= 6}
    for s, n in low.items():
        for i in range(len(s)):
            rest = s[:i] + s[i + 1 :]
            assert not rest or low[rest] >= n


def test_row_order_and_partitions_do_not_matter(spark):
    baskets = random_baskets(10)
    shuffled = rows_frame(spark, baskets).orderBy("item").repartition(7)
    assert collected(bw.frequent_itemsets(shuffled, 4)) == brute_force(baskets, 4)


@pytest.mark.parametrize(
    "options",
    [
        {"min_support": 0},
        {"min_support": 1, "algorithm": "unknown"},
        {"min_support": 1, "max_len": 0},
        {"min_support": 1, "num_groups": 0},
    ],
)
def test_bad_arguments(spark, options):
    with pytest.raises(ValueError):
        bw.frequent_itemsets(baskets_frame(spark, [["a"]]), **options)


def test_published_names(spark):
    data = baskets_frame(spark, [line.split() for line in DEMO])
    assert collected(bw.frequent_itemsets(data, 2, "nonordfp")) == DEMO_ITEMSETS


def test_large_dictionary_and_unbroadcast_lookups(spark, monkeypatch):
    """The ways taken at scale, forced on small data."""
    from basketweave.functions import joins
    from basketweave.operators import candidates
    from basketweave.plans import encode

    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(encode, "DICTIONARY_BYTES", 0)
    monkeypatch.setattr(candidates, "PAIR_BLOCK", 2)
    baskets = random_baskets(11, n=40, items="aaaabcdef")
    for algorithm in ("apriori", "eclat", "pair_pruned", "prefix_array", "cells"):
        found = bw.frequent_itemsets(rows_frame(spark, baskets), 3, algorithm)
        assert collected(found) == brute_force(baskets, 3), algorithm


def test_builtin_cuts_wide_baskets_to_blocks(spark, monkeypatch):
    """Short itemsets are mined in blocks, and the model never sees a whole wide basket."""
    monkeypatch.setattr(builtin, "BLOCK_ITEMS", 6)
    widest = []
    write = bw.Workspace.write

    def seen(ws, name, *a, **k):
        table = write(ws, name, *a, **k)
        if name == "blocks":
            widest.append(table.df.agg(F.max(F.size("items"))).first()[0])
        return table

    monkeypatch.setattr(bw.Workspace, "write", seen)
    rng = random.Random(41)
    baskets = [rng.sample("abcdefghijklm", rng.randint(0, 11)) for _ in range(60)] + [["rare", ""]]
    for max_len in (2, 3):
        found = bw.frequent_itemsets(rows_frame(spark, baskets), 4, "builtin", max_len=max_len)
        assert collected(found) == brute_force(baskets, 4, max_len)
    assert len(widest) == 2 and max(widest) <= 9
