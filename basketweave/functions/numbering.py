"""Consecutive numbers for the rows of a distributed frame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketweave.workspace import Workspace

# A running id is (partition << PART_BITS) + place in the partition.
PART_BITS = 33


def dense_numbers(ws: Workspace, df: DataFrame, name: str) -> DataFrame:
    """Number the rows 0, 1, … in partition order, as a BIGINT column `name`.

    The running ids are written once, so they cannot change; adding the sizes of
    the partitions before gives the number. The frame of partition sizes has one
    row per partition.
    """
    running = F.monotonically_increasing_id()
    placed = ws.write("numbered", df.select("*", running.alias("_id"))).df.select(
        *df.columns,
        F.shiftright("_id", PART_BITS).alias("_part"),
        F.col("_id").bitwiseAND((1 << PART_BITS) - 1).alias("_place"),
    )
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = F.sum("_size").over(W.orderBy("_part")) - F.col("_size")
    starts = sizes.select("_part", before.alias("_start"))
    return placed.join(F.broadcast(starts), "_part").select(
        (F.col("_start") + F.col("_place")).alias(name), *df.columns
    )
