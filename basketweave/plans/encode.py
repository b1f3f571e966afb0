"""The common start and end of every strategy: items to ranks, ranks to items."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketweave.functions import lookup_join
from basketweave.operators.counting import (
    ENTRY_BYTES,
    compress_transactions,
    frequent_items,
    item_rank,
    prune_transactions,
)
from basketweave.workspace import Table, Workspace

ITEMSETS_SCHEMA = "itemset ARRAY<STRING>, k INT, freq BIGINT"
# Up to this size the dictionary is one array that rows index in place.
DICTIONARY_BYTES = 8 * 1024 * 1024


@dataclass(frozen=True)
class Dictionary:
    """The frequent items, counted and ranked: ``(item, freq, rk)``."""

    df: DataFrame
    rows: int
    row_bytes: int


def empty_itemsets(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], ITEMSETS_SCHEMA)


def rank_dictionary(ws: Workspace, data: DataFrame, min_support: int) -> Dictionary | None:
    """Count, threshold and rank the items; None if none is frequent."""
    items = ws.write(
        "items", frequent_items(data, min_support), bytes=F.sum(F.octet_length("item"))
    )
    if not items.rows:
        return None
    row_bytes = ENTRY_BYTES + -(-items.stats["bytes"] // items.rows)
    return Dictionary(item_rank(items.df, ws), items.rows, row_bytes)


def encode_baskets(ws: Workspace, data: DataFrame, items: Dictionary) -> Table:
    """Merged transactions as rank arrays: ``(prefix, w)``.

    Reads `data` a second time rather than a copy of its distinct rows: infrequent
    items then go right after the scan, before anything is shuffled or written.
    Observes `width`, the longest array.
    """
    return ws.write(
        "baskets",
        compress_transactions(prune_transactions(data, items.df, items.rows, items.row_bytes)),
        width=F.max(F.size("prefix")),
    )


def single_itemsets(items: Dictionary) -> DataFrame:
    return items.df.select(F.array("rk").alias("itemset"), "freq")


def decode(items: Dictionary, levels: list[DataFrame]) -> DataFrame:
    """Frames of rank itemsets ``(itemset, freq)`` as one frame of item names."""
    found = reduce(DataFrame.unionByName, levels)
    if items.rows * items.row_bytes <= DICTIONARY_BYTES:
        entries = F.array_sort(F.collect_list(F.struct("rk", "item")))
        names = items.df.agg(F.transform(entries, lambda e: e["item"])).scalar()
        named = found.withColumn("names", names).select(
            F.transform("itemset", lambda r: F.get(F.col("names"), r)).alias("itemset"), "freq"
        )
    else:
        rows = found.select("itemset", "freq", F.explode("itemset").alias("rk"))
        names = items.df.select("rk", "item")
        named = (
            lookup_join(rows, names, "rk", items.rows, items.row_bytes, ["itemset"])
            .groupBy(F.col("itemset").alias("ranks"), "freq")
            .agg(F.collect_list("item").alias("itemset"))
        )
    return named.select(
        F.sort_array("itemset").alias("itemset"), F.size("itemset").alias("k"), "freq"
    )
