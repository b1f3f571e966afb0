"""The pair counts as a block-triangular matrix.

Ranks are the rows and columns; the pair of `left` before `right` is a cell below the
diagonal. A row is cut into blocks of CELLS cells, and a block is one row of the table,
an array of counts. A task sums whole blocks before the shuffle, so a row of the shuffle
carries CELLS pairs, and none is made for a single pair of a basket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketweave.functions import expand_positions

# Cells of a block: the bits of an integer that names the items a basket has of it.
CELLS = 32


def _block(item: Column) -> Column:
    return F.floor(item / CELLS).cast("int")


def _bits(items: Column) -> Column:
    """The places of items within their block, as bits."""
    return F.aggregate(
        items,
        F.lit(0).cast("bigint"),
        lambda bits, x: bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), x % CELLS)),
    )


def pair_matrix(compressed: DataFrame, width: int | None = None) -> DataFrame:
    """The matrix of merged baskets ``(prefix, w)``: ``(right, block, counts)``.

    ``counts[i]`` is how many transactions hold both ``right`` and the item
    ``block * CELLS + i``, which ranks before it. Blocks without a pair have no row.
    `width` is the longest prefix, if known.
    """
    blocks = F.array_distinct(F.transform("prefix", _block))
    segments = F.transform(
        blocks,
        lambda b: F.struct(
            b.alias("block"), _bits(F.filter("prefix", lambda x: _block(x) == b)).alias("bits")
        ),
    )
    rows = expand_positions(compressed.withColumn("_segments", segments), "prefix", width).select(
        F.col("item").alias("right"), "w", "_segments"
    )
    before = F.filter("_segments", lambda s: s["block"] <= _block(F.col("right")))
    held = rows.select("right", "w", F.explode(before).alias("s"))
    # Of the own block only what ranks before the item.
    lower = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("right") % CELLS) - 1
    bits = F.when(F.col("s.block") == _block(F.col("right")), F.col("s.bits").bitwiseAND(lower))
    cells = held.select("right", "w", F.col("s.block").alias("block"), bits.otherwise(F.col("s.bits")).alias("bits"))
    sums = [F.sum(F.getbit("bits", F.lit(i)) * F.col("w")).alias(f"c{i}") for i in range(CELLS)]
    return (
        cells.filter("bits <> 0")
        .groupBy("right", "block")
        .agg(*sums)
        .select("right", "block", F.array(*[f"c{i}" for i in range(CELLS)]).alias("counts"))
    )


def matrix_pairs(matrix: DataFrame, min_support: int = 1) -> DataFrame:
    """The cells from `min_support` on as pairs: ``(left, right, freq)``."""
    cells = matrix.select("right", "block", F.posexplode("counts").alias("at", "freq"))
    left = (F.col("block") * CELLS + F.col("at")).cast("int").alias("left")
    return cells.filter(F.col("freq") >= max(min_support, 1)).select(left, "right", "freq")
