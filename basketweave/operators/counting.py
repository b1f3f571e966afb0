"""Counting, filtering and ranking of items; pruning and merging of baskets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketweave.functions import dense_numbers, lookup_join
from basketweave.sources.transactions import long_rows
from basketweave.workspace import Table, Workspace

# Estimated size of one dictionary entry in memory, besides the name itself.
ENTRY_BYTES = 80


def transaction_count(data: DataFrame) -> DataFrame:
    """The number of transactions, as a one-row frame ``(n)``."""
    if "items" in data.columns:
        return data.agg(F.count(F.lit(1)).alias("n"))
    return data.select("tid").distinct().agg(F.count(F.lit(1)).alias("n"))


def count_items(rows: DataFrame) -> DataFrame:
    """`item_counts` of rows that are known to be distinct."""
    return rows.groupBy("item").agg(F.count(F.lit(1)).alias("freq"))


def item_counts(data: DataFrame) -> DataFrame:
    """The number of transactions that hold each item: ``(item, freq)``."""
    return count_items(long_rows(data))


def frequent_items(data: DataFrame, min_support: int) -> DataFrame:
    """`item_counts` from `min_support` on."""
    return item_counts(data).filter(F.col("freq") >= min_support)


def frequent_lookup(ws: Workspace, rows: DataFrame, min_support: int) -> Table:
    """The frequent items of distinct `rows`, written, with what a join must know.

    Observes `bytes`, the size of all names, and `most`, the greatest count.
    """
    counts = count_items(rows).filter(F.col("freq") >= min_support)
    return ws.write(
        "frequent", counts, bytes=F.sum(F.octet_length(F.col("item").cast("string"))), most=F.max("freq")
    )


def keep_frequent(rows: DataFrame, frequent: Table) -> DataFrame:
    """The `rows` whose item is in a lookup of `frequent_lookup`; hot items are split."""
    row_bytes = ENTRY_BYTES + -(-frequent.stats["bytes"] // max(frequent.rows, 1))
    items = frequent.df.select("item")
    return lookup_join(rows, items, "item", frequent.rows, row_bytes, ["tid"], "left_semi")


def item_rank(items: DataFrame, ws: Workspace | None = None) -> DataFrame:
    """Number the items 0, 1, … by count descending, then by name: ``(item, freq, rk)``.

    A distributed sort gives the order, so a dictionary of any size is ranked.
    """
    ws = ws or Workspace(items.sparkSession)
    ordered = items.select("item", "freq").orderBy(F.desc("freq"), "item")
    ranked = dense_numbers(ws, ordered, "rk").select("item", "freq", F.col("rk").cast("int"))
    return ws.write("ranked_items", ranked).df


def prune_transactions(
    data: DataFrame, rank: DataFrame, rank_rows: int | None = None, row_bytes: int = ENTRY_BYTES
) -> DataFrame:
    """Keep frequent items only, as ranks in rank order: ``(tid, items ARRAY<INT>)``.

    `rank_rows` and `row_bytes` are the size of the dictionary, which is measured if it is
    not given.
    Items are looked up in long form and regrouped as integers, so the shuffle by
    transaction moves ranks, not names, and an array is never longer than the
    dictionary. Transactions without a frequent item have no row.
    """
    rows = long_rows(data, distinct=False)
    ranks = rank.select("item", "rk")
    if rank_rows is None:
        names = F.octet_length(F.col("item").cast("string"))
        rank_rows, size = ranks.agg(F.count(F.lit(1)), F.sum(names)).first()
        row_bytes = ENTRY_BYTES + -(-(size or 0) // max(rank_rows, 1))
    coded = lookup_join(rows, ranks, "item", rank_rows, row_bytes, salt_on=["tid"])
    return coded.groupBy("tid").agg(F.sort_array(F.collect_set("rk")).alias("items"))


def compress_transactions(pruned: DataFrame) -> DataFrame:
    """Merge equal baskets: ``(prefix ARRAY<INT>, w)``, `w` being how many there are."""
    return pruned.groupBy(F.col("items").alias("prefix")).agg(F.count(F.lit(1)).alias("w"))


def itemset_support(itemsets: DataFrame, n: DataFrame) -> DataFrame:
    """Relative support ``freq / n``; `n` is the one-row frame of `transaction_count`."""
    return itemsets.withColumn("support", F.col("freq") / n.select("n").scalar())
