"""Vertical layout as bitmaps: one bit per transaction, in fixed blocks.

A dense transaction number has a block, ``bitmap_bucket_number``, and a bit in it,
``bitmap_bit_position``. A list is cut into blocks of 32,768 transactions (4 KiB), so no
value grows with the data, and lists that are met lie in the same blocks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketweave.functions import dense_numbers, lookup_join
from basketweave.operators.counting import frequent_lookup, keep_frequent
from basketweave.sources.transactions import long_rows
from basketweave.workspace import Workspace

# Transactions of one block, as Spark's bitmap functions cut them.
BLOCK_TIDS = 32_768
# A numbered transaction in memory.
TID_BYTES = 80


def number_transactions(ws: Workspace, rows: DataFrame) -> DataFrame:
    """Distinct ``(tid, item)`` rows with tids 1, 2, … in place of what they were.

    Bitmap functions count from one. Transactions are numbered by a distributed pass; a
    large one is split in the join, as its rows are dealt by item.
    """
    tids = ws.write("tids", rows.select("tid").distinct())
    numbers = dense_numbers(ws, tids.df, "_n").select("tid", (F.col("_n") + 1).alias("_n"))
    return lookup_join(rows, numbers, "tid", tids.rows, TID_BYTES, ["item"]).select(
        F.col("_n").alias("tid"), "item"
    )


def block_bitmaps(rows: DataFrame, key: str) -> DataFrame:
    """Rows ``(key, tid)``, tids from 1, as ``(key, block, bits)``."""
    return rows.groupBy(key, F.bitmap_bucket_number("tid").alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("tid")).alias("bits")
    )


def tid_bitmaps(data: DataFrame, min_support: int, workspace: Workspace | None = None) -> DataFrame:
    """Per frequent item its transactions: ``(item, block, bits)``.

    A block holds up to BLOCK_TIDS transactions, so the bits of a very common item are
    many rows of 4 KiB; the threshold is on their sum.
    """
    ws = workspace or Workspace(data.sparkSession)
    rows = long_rows(data)
    frequent = frequent_lookup(ws, rows, min_support)
    kept = keep_frequent(rows, frequent)
    return block_bitmaps(number_transactions(ws, kept), "item")


def bitmap_sizes(bitmaps: DataFrame, key: str, min_support: int = 1) -> DataFrame:
    """The number of transactions of each key: ``(key, freq)``, thresholded."""
    return (
        bitmaps.groupBy(key)
        .agg(F.sum(F.bitmap_count("bits")).alias("freq"))
        .filter(F.col("freq") >= min_support)
    )


def intersect_bitmap_classes(bitmaps: DataFrame) -> DataFrame:
    """Bitmaps one item longer: ``(stem, last, block, bits)`` from the same columns.

    All bitmaps of a stem and block meet in one place, are paired there and intersected by
    ``bitmap_and_agg``; the pairs are grouped where they are, without a further shuffle.
    Blocks in which no transaction holds both are left out.
    """
    left = bitmaps.withColumnsRenamed({"last": "a", "bits": "one"})
    right = bitmaps.withColumnsRenamed({"last": "b", "bits": "two"})
    return (
        left.join(right, ["stem", "block"])
        .filter("a < b")
        .select("stem", "block", "a", "b", F.explode(F.array("one", "two")).alias("bits"))
        .groupBy("stem", "block", "a", "b")
        .agg(F.bitmap_and_agg("bits").alias("bits"))
        .filter(F.bitmap_count("bits") > 0)
        .select(F.concat("stem", F.array("a")).alias("stem"), F.col("b").alias("last"), "block", "bits")
    )
