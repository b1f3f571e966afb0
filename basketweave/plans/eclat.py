"""Vertical mining: the support of an itemset is the length of its tid list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketweave.functions import expand_positions, lookup_join
from basketweave.operators.counting import compress_transactions, prune_transactions
from basketweave.operators.patterns import count_pairs
from basketweave.operators.tidlists import bucket_count, intersect_classes
from basketweave.plans.encode import (
    decode,
    empty_itemsets,
    rank_dictionary,
    single_itemsets,
)
from basketweave.workspace import Table, Workspace

# Tid arrays that are worth a task of their own; an equivalence class in memory, besides
# its members.
LISTS_PER_TASK, CLASS_BYTES = 8, 100
# Bits of a weight; a bucket holds the tids that share one.
WEIGHT_BITS = 64


def _write_classes(ws: Workspace, counts: DataFrame) -> Table:
    """Frequent itemsets ``(stem, last, freq)`` as equivalence classes, a row per stem."""
    members = F.collect_list("last").alias("lasts"), F.collect_list("freq").alias("freqs")
    return ws.write(
        "classes",
        counts.groupBy("stem").agg(*members),
        grows=F.count_if(F.size("lasts") > 1),
        largest=F.max(F.size("lasts")),
        members=F.sum(F.size("lasts")),
    )


def _itemsets(classes: Table) -> DataFrame:
    found = F.explode(F.arrays_zip("lasts", "freqs")).alias("found")
    return classes.df.select("stem", found).select(
        F.concat("stem", F.array("found.lasts")).alias("itemset"), F.col("found.freqs").alias("freq")
    )


def _class_bytes(classes: Table, k: int) -> int:
    return CLASS_BYTES + 4 * k + 4 * -(-classes.stats["members"] // max(classes.rows, 1))


def _pair_lists(baskets: Table, classes: Table, buckets: int) -> DataFrame:
    """The tid lists of the frequent pairs, read off the baskets."""
    rows = expand_positions(baskets.spread(), "items", baskets.stats["width"])
    stems = classes.df.filter(F.size("lasts") > 1).select(
        F.col("stem")[0].alias("item"), "stem", F.col("lasts").alias("_members")
    )
    met = lookup_join(rows, stems, "item", classes.rows, _class_bytes(classes, 2), ["tid"])
    # A basket's items after the stem item that make a frequent pair with it.
    after = F.slice("items", F.col("pos") + 2, F.size("items"))
    bucket = F.pmod(F.xxhash64("tid"), F.lit(buckets)) * WEIGHT_BITS + F.col("bit")
    return (
        met.select("tid", "bit", "stem", F.explode(F.array_intersect(after, "_members")).alias("last"))
        .groupBy("stem", "last", bucket.alias("bucket"))
        .agg(F.collect_list("tid").alias("tids"))
    )


def _weight() -> Column:
    """What a tid of a list stands for, by the bit that its bucket names."""
    return F.expr(f"shiftleft(1L, cast(bucket % {WEIGHT_BITS} as int))")


def _weighted(merged: DataFrame) -> DataFrame:
    """Merged baskets ``(items, w)`` with a row for each bit of ``w``: ``(tid, bit, items)``."""
    bits = F.filter(F.sequence(F.lit(0), F.lit(WEIGHT_BITS - 2)), lambda bit: F.getbit("w", bit) == 1)
    numbered = merged.select(F.monotonically_increasing_id().alias("tid"), "items", bits.alias("bits"))
    return numbered.select("tid", F.explode("bits").alias("bit"), "items")


def mine_eclat(
    ws: Workspace,
    data: DataFrame,
    min_support: int,
    max_len: int | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Intersect the tid lists of two parents to get each candidate's list.

    Equal baskets are one tid, which stands for as many transactions as there are of them:
    the tid is in a list of its own for each bit of that weight, so a list is still a plain
    set, and counts as its size times the bit. Lists are cut into buckets of tids, so no
    array grows with the data. The
    frequent pairs are counted from the baskets first, and their lists are made there;
    from then on the lists of one equivalence class, which share all items but the last,
    meet in one place per bucket and are intersected with each other.
    """
    items = rank_dictionary(ws, data, min_support)
    if items is None:
        return empty_itemsets(ws.spark)
    levels = [single_itemsets(items)]
    if max_len == 1:
        return decode(items, levels)

    pruned = prune_transactions(data, items.df, items.rows, items.row_bytes)
    merged = compress_transactions(pruned).withColumnRenamed("prefix", "items")
    # Numbered here once and read back, so the ids cannot change later.
    baskets = ws.write("baskets", _weighted(merged), width=F.max(F.size("items")))
    weight = F.expr("shiftleft(1L, bit)").alias("w")
    whole = baskets.spread().select(F.lit(0).alias("suffix"), F.col("items").alias("prefix"), weight)
    pairs = count_pairs(whole, min_support, baskets.stats["width"])
    classes = _write_classes(
        ws, pairs.select(F.array("left").alias("stem"), F.col("right").alias("last"), "freq")
    )
    lists, k = None, 2
    while classes.rows:
        levels.append(_itemsets(classes))
        if not classes.stats["grows"] or (max_len is not None and k >= max_len):
            break
        if lists is None:
            tasks = int(ws.spark.conf.get("spark.sql.shuffle.partitions"))
            cut = buckets or bucket_count(baskets.rows, tasks)
            lists = ws.write("lists", _pair_lists(baskets, classes, cut))
        members = classes.df.select("stem", "lasts")
        longer = intersect_classes(
            lists.spread(LISTS_PER_TASK), members, classes.rows, _class_bytes(classes, k), classes.stats["largest"]
        )
        before, lists = lists, ws.write("lists", longer)
        ws.drop(before)
        k += 1
        counts = lists.df.groupBy("stem", "last").agg(F.sum(F.size("tids") * _weight()).alias("freq"))
        classes = _write_classes(ws, counts.filter(F.col("freq") >= min_support))
    if lists is not None:
        ws.drop(lists)
    ws.drop(baskets)
    return decode(items, levels)
