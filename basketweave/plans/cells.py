"""Mining over the cells of the prefix tree.

The base of a suffix is a set of cells: a node of the tree with the weight that reaches
it. A cell passes its weight to the nodes above it, which are the cells of the suffixes
one item longer. A row names its cell by its place in a basket and holds no prefix, so a
round shuffles rows of a fixed size, and equal prefixes were merged when the tree was.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketweave.functions import lookup_join
from basketweave.operators.trees import POSITION_BYTES, tree_cells
from basketweave.plans.encode import (
    decode,
    empty_itemsets,
    encode_baskets,
    rank_dictionary,
    single_itemsets,
)
from basketweave.workspace import Table, Workspace

# A basket in memory, besides its positions; an itemset with its siblings, besides these.
LINE_BYTES, KEEP_BYTES = 100, 100


def _passed_up(cells: DataFrame, lines: Table) -> DataFrame:
    """The cells above each of `cells` whose item is in `keep`, for longer suffixes."""
    row_bytes = LINE_BYTES + POSITION_BYTES * -(-lines.stats["items"] // max(lines.rows, 1))
    found = lookup_join(cells, lines.df, "b", lines.rows, row_bytes, ["suffix"])
    above = F.slice(F.arrays_zip("prefix", "places"), F.lit(1), F.col("pos"))
    return (
        found.select("suffix", "w", "keep", F.posexplode(above).alias("pos", "cell"))
        .filter(F.col("keep").isNull() | F.array_contains("keep", F.col("cell.prefix")))
        .groupBy(
            F.concat(F.array("cell.prefix"), "suffix").alias("suffix"),
            F.col("cell.places").alias("b"),
            "pos",
        )
        .agg(F.sum("w").alias("w"))
    )


def mine_cells(
    ws: Workspace, data: DataFrame, min_support: int, max_len: int | None = None
) -> DataFrame:
    """Pass the weights of cells up the tree, one suffix length per round."""
    items = rank_dictionary(ws, data, min_support)
    if items is None:
        return empty_itemsets(ws.spark)
    levels = [single_itemsets(items)]
    if max_len == 1:
        return decode(items, levels)

    baskets = encode_baskets(ws, data, items)
    lines, nodes = tree_cells(ws, baskets)
    ws.drop(baskets)
    cells = nodes.df.filter("pos > 0").select(
        F.array("item").alias("suffix"), "b", "pos", "w", F.lit(None).cast("array<int>").alias("keep")
    )
    held, k = nodes, 1
    while max_len is None or k < max_len:
        before, held = held, ws.write("cells", _passed_up(cells, lines))
        ws.drop(before)
        k += 1
        # The frequent itemsets by the suffix that they grew from.
        of = F.expr("slice(suffix, 2, size(suffix) - 1)")
        counts = ws.write(
            "counts",
            held.df.groupBy("suffix")
            .agg(F.sum("w").alias("freq"))
            .filter(F.col("freq") >= min_support)
            .groupBy(of.alias("stem"))
            .agg(F.collect_list(F.element_at("suffix", 1)).alias("keep"), F.collect_list("freq").alias("freqs")),
            grows=F.count_if(F.size("keep") > 1),
            kept=F.sum(F.size("keep")),
        )
        if not counts.rows:
            break
        found = F.explode(F.arrays_zip("keep", "freqs")).alias("found")
        levels.append(
            counts.df.select("stem", found).select(
                F.concat(F.array("found.keep"), "stem").alias("itemset"), F.col("found.freqs").alias("freq")
            )
        )
        if not counts.stats["grows"]:
            break
        # An itemset grows by its siblings only, so one without any has no further round.
        keep = counts.df.filter(F.size("keep") > 1).select("stem", "keep")
        row_bytes = KEEP_BYTES + 4 * (k + -(-counts.stats["kept"] // counts.rows))
        grown = held.df.filter("pos > 0").withColumn("stem", of)
        cells = lookup_join(grown, keep, "stem", counts.rows, row_bytes, ["b"]).filter(
            F.array_contains("keep", F.element_at("suffix", 1))
        )
    ws.drop(held)
    ws.drop(lines)
    return decode(items, levels)
