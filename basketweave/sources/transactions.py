"""Transactions from text files and from relational rows.

Two shapes of the same data are accepted everywhere: ``(tid, items)`` with one
array per basket, and ``(tid, item)`` with one row per item. A basket is a set:
duplicates count once and empty strings are not items.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketweave.functions import dense_numbers
from basketweave.workspace import Workspace


def read_transactions(
    spark: SparkSession, path: str | list[str], delimiter: str = " ", tid: str | None = "tid"
) -> DataFrame:
    """Text, one transaction per line, as ``(tid, items)``.

    A blank line is a transaction without items. `tid` names the generated key;
    pass None to leave it out where only the item arrays matter.
    """
    tokens = F.split("value", re.escape(delimiter))
    items = F.sort_array(F.array_distinct(F.filter(tokens, lambda x: x != "")))
    lines = spark.read.text(path).select(items.alias("items"))
    return lines if tid is None else assign_tids(lines, tid)


def assign_tids(
    transactions: DataFrame, tid: str = "tid", dense: bool = False, workspace: Workspace | None = None
) -> DataFrame:
    """Number the transactions.

    The default numbers are unique, not consecutive, and cost no shuffle. They
    depend on the partitioning of the input, so write the result before it is
    read twice. `dense` gives 0..n-1, from a copy written to `workspace`.
    """
    if dense:
        return dense_numbers(workspace or Workspace(transactions.sparkSession), transactions, tid)
    return transactions.select(F.monotonically_increasing_id().alias(tid), "*")


def transactions_from_rows(rows: DataFrame, key: str, item: str) -> DataFrame:
    """Relational rows to ``(tid, items)``: one basket per `key`, items sorted.

    A basket is one array, made in one task. Where single baskets may be huge, keep the
    long rows, which all strategies take, or prune infrequent items first.
    """
    kept = rows.filter(F.col(item).isNotNull() & (F.col(item) != ""))
    return kept.groupBy(F.col(key).alias("tid")).agg(
        F.sort_array(F.collect_set(item)).alias("items")
    )


def explode_items(transactions: DataFrame) -> DataFrame:
    """``(tid, items)`` to long ``(tid, item)`` rows."""
    return transactions.select("tid", F.explode("items").alias("item"))


def long_rows(data: DataFrame, distinct: bool = True) -> DataFrame:
    """Either input shape as ``(tid, item)`` rows, each pair once if `distinct`.

    Array input needs no shuffle for that: duplicates sit inside one row.
    """
    if "items" in data.columns:
        items = F.filter(F.array_distinct("items"), lambda x: x.isNotNull() & (x != ""))
        return explode_items(data.select("tid", items.alias("items")))
    rows = data.select("tid", "item").filter(F.col("item").isNotNull() & (F.col("item") != ""))
    return rows.distinct() if distinct else rows
