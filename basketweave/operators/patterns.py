"""Conditional transactions, pattern bases and pair counts.

A pattern base is a frame ``(suffix ARRAY<INT>, prefix ARRAY<INT>, w BIGINT)``:
`w` transactions hold `suffix`, and `prefix` lists their items that rank before
it. Whole transactions are the base of the empty suffix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketweave.functions import expand_positions, lookup_join, once, project
from basketweave.operators.counting import frequent_lookup, keep_frequent
from basketweave.sources.transactions import long_rows
from basketweave.workspace import Workspace


def pattern_base(compressed: DataFrame) -> DataFrame:
    """Merged transactions as the pattern base of the empty suffix."""
    return compressed.select(F.array().cast("array<int>").alias("suffix"), "prefix", "w")


def conditional_transactions(
    pruned: DataFrame, num_groups: int, array: str = "items"
) -> DataFrame:
    """For each group, the longest prefix that ends in an item the group owns.

    Group ``rk % num_groups`` owns item `rk`; a transaction gives each group at
    most one row ``(…, grp, prefix)``. Computed inside the row, without a shuffle.
    """
    ends = F.array_sort(
        F.transform(array, lambda x, i: F.struct((x % num_groups).alias("grp"), i.alias("pos")))
    )
    # Sorted by group, the last position of a group is the one before a change.
    last = F.filter(
        F.col("_ends"),
        lambda e, i: (i == F.size("_ends") - 1)
        | (F.get(F.col("_ends"), i + 1)["grp"] != e["grp"]),
    )
    others = [c for c in pruned.columns if c != array]
    return (
        pruned.withColumn("_ends", ends)
        .withColumn("_end", F.explode(last))
        .select(
            *others,
            F.col("_end.grp").alias("grp"),
            F.slice(array, F.lit(1), F.col("_end.pos") + 1).alias("prefix"),
        )
    )


def conditional_pattern_base(
    base: DataFrame,
    width: int | None = None,
    owner: Column | None = None,
    keep_empty: bool = False,
) -> DataFrame:
    """The pattern bases of all suffixes one item longer, equal rows merged.

    `owner` restricts the new items (group sharding); rows without a prefix carry
    no further pattern and are kept only on request.
    """
    rows = expand_positions(base, "prefix", width)
    if owner is not None:
        rows = rows.filter(owner)
    if not keep_empty:
        rows = rows.filter("pos > 0")
    return (
        rows.select(
            F.concat(F.array("item"), "suffix").alias("suffix"),
            F.slice("prefix", F.lit(1), F.col("pos")).alias("prefix"),
            "w",
        )
        .groupBy("suffix", "prefix")
        .agg(F.sum("w").alias("w"))
    )


def extension_counts(base: DataFrame, min_support: int) -> DataFrame:
    """Weighted count of each item within each pattern base, thresholded.

    ``(suffix, item, freq)`` and `width`, the longest prefix that holds the item.
    """
    return (
        base.select(
            "suffix", F.explode("prefix").alias("item"), "w", F.size("prefix").alias("size")
        )
        .groupBy("suffix", "item")
        .agg(F.sum("w").alias("freq"), F.max("size").alias("width"))
        .filter(F.col("freq") >= min_support)
    )


def conditional_item_counts(base: DataFrame, min_support: int) -> DataFrame:
    """Items that are frequent together with a suffix: ``(suffix, item, freq)``."""
    return extension_counts(base, min_support).select("suffix", "item", "freq")


def kept_items(counts: DataFrame) -> DataFrame:
    """The frequent items of each suffix as one array: ``(suffix, keep)``.

    They stand in the suffix's own order, the most frequent with it first, then by rank.
    """
    return counts.groupBy("suffix").agg(
        F.transform(ordered_items("item", "freq"), lambda x: x["item"]).alias("keep")
    )


def ordered_items(item: str, freq: str) -> Column:
    """An aggregate: all items with their counts, ``(item, freq)``, the most frequent first."""
    entries = F.array_sort(F.collect_list(F.struct((-F.col(freq)).alias("order"), F.col(item).alias("item"))))
    return F.transform(entries, lambda x: F.struct(x["item"].alias("item"), (-x["order"]).alias("freq")))


def project_prefixes(
    base: DataFrame,
    keep: DataFrame,
    keep_rows: int | None = None,
    row_bytes: int = 256,
    local_order: bool = False,
) -> DataFrame:
    """Drop the items that are infrequent within their pattern base.

    With `local_order` what is left stands in the order of `keep`, as `kept_items` gives
    it. Prefixes that begin with what is frequent there have longer beginnings in common,
    so more of them are equal once they are cut at an item.

    `keep` comes from `kept_items`; `keep_rows` and `row_bytes` are its measured size,
    which is taken if it is not given. Rows that lose all items go.
    """
    if keep_rows is None:
        keep_rows, kept = keep.agg(F.count(F.lit(1)), F.sum(F.size("keep"))).first()
        row_bytes += 4 * -(-(kept or 0) // max(keep_rows, 1))
    rows = lookup_join(base, keep, "suffix", keep_rows, row_bytes, salt_on=["prefix"])
    sides = (F.col("keep"), F.col("prefix")) if local_order else (F.col("prefix"), F.col("keep"))
    projected = once(project(*sides)).alias("prefix")
    return rows.select("suffix", projected, "w").filter(F.size("prefix") > 0)


def count_pairs(base: DataFrame, min_support: int, width: int | None = None) -> DataFrame:
    """Weighted count of each item pair within each pattern base, thresholded.

    ``(suffix, left, right, freq)`` where `left` ranks before `right`. Pairs come
    from inside a row and are summed before the shuffle.
    """
    rows = expand_positions(base, "prefix", width).filter("pos > 0")
    return (
        rows.select(
            "suffix",
            F.col("item").alias("right"),
            F.explode(F.slice("prefix", F.lit(1), F.col("pos"))).alias("left"),
            "w",
        )
        .groupBy("suffix", "left", "right")
        .agg(F.sum("w").alias("freq"))
        .filter(F.col("freq") >= min_support)
    )


def pair_counts(
    data: DataFrame, min_support: int = 1, workspace: Workspace | None = None
) -> DataFrame:
    """Co-occurrence count of every item pair: ``(item_a, item_b, freq)``, a < b.

    Items that are infrequent on their own go first, and equal baskets are merged and
    written, so many copies of one basket are paired once and a wide one is cut into
    pieces for several tasks. Before that a basket is one array in one task, of its
    frequent items only.
    """
    ws = workspace or Workspace(data.sparkSession)
    rows = long_rows(data)
    if min_support > 1:
        rows = keep_frequent(rows, frequent_lookup(ws, rows, min_support))
    merged = (
        rows.groupBy("tid")
        .agg(F.sort_array(F.collect_list("item")).alias("prefix"))
        .groupBy("prefix")
        .agg(F.count(F.lit(1)).alias("w"))
    )
    baskets = ws.write("baskets", merged, width=F.max(F.size("prefix")))
    base = baskets.df.withColumn("suffix", F.lit(0))
    return count_pairs(base, min_support, baskets.stats["width"]).select(
        F.col("left").alias("item_a"), F.col("right").alias("item_b"), "freq"
    )
