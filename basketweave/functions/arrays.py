"""Column expressions over itemset arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A row with a wider array is cut into pieces of this many positions.
WIDE_ROW = 1024


def subsets(items: Column, max_len: int | None = None, element: str = "int") -> Column:
    """All subsets of an array, the empty one included, up to `max_len` items."""

    def add(found: Column, item: Column) -> Column:
        short = found if max_len is None else F.filter(found, lambda s: F.size(s) < max_len)
        return F.concat(found, F.transform(short, lambda s: F.concat(s, F.array(item))))

    empty = F.array(F.array()).cast(f"array<array<{element}>>")
    return F.aggregate(items, empty, add)


def without_each(items: Column) -> Column:
    """The arrays left when each element in turn is taken out."""
    return F.transform(
        items,
        lambda _, i: F.concat(F.slice(items, F.lit(1), i), F.slice(items, i + 2, F.size(items))),
    )


def project(prefix: Column, keep: Column) -> Column:
    """`prefix` without the items outside `keep`, in its own order."""
    return F.array_intersect(prefix, keep)


def once(value: Column) -> Column:
    """`value` as the output of a one-element explode.

    The optimizer moves a filter on a computed column below the projection and so
    evaluates the column twice; it does not move one below an explode.
    """
    return F.explode(F.array(value))


def expand_positions(df: DataFrame, array: str, width: int | None = None) -> DataFrame:
    """One row per array element: adds `pos` (0-based) and `item`.

    `width` is the longest array, if known. When some are longer than WIDE_ROW, arrays
    are cut into pieces first, which are dealt to all tasks, so one huge basket is not
    expanded by a single task. The input is read once, and a piece of a wide row holds
    its own items only, unless the other columns hold more.
    """
    if width is None or width <= WIDE_ROW:
        return df.select("*", F.posexplode(array).alias("pos", "item"))
    starts = F.sequence(F.lit(0), F.greatest(F.size(array) - 1, F.lit(0)), F.lit(WIDE_ROW))
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        df.withColumn("_from", F.explode(starts))
        .withColumn("_piece", F.slice(array, F.col("_from") + 1, WIDE_ROW))
        .repartition(tasks, F.xxhash64("_piece"), F.col("_from"))
        .select("*", F.posexplode("_piece").alias("_i", "item"))
        .withColumn("pos", F.col("_from") + F.col("_i"))
        .drop("_from", "_piece", "_i")
    )
