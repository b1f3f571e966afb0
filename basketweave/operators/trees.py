"""The prefix tree of all baskets, as tables.

Baskets in rank order that begin alike share their first nodes. A node is named by a hash
of its path, so every row finds its nodes by itself, and equal prefixes of different
baskets meet in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketweave.functions import expand_positions, lookup_join
from basketweave.workspace import Table, Workspace

NODE = "struct<a:bigint,b:bigint>"
# A node of the tree in memory; a position of a basket in its two arrays.
NODE_BYTES, POSITION_BYTES = 96, 16


def path_names(items: Column) -> Column:
    """The name of every prefix of an array: 128 bits, each from the one before."""

    def longer(names: Column, item: Column) -> Column:
        before = F.get(names, F.size(names) - 1)
        name = F.struct(
            F.xxhash64(F.lit(1), before["a"], item).alias("a"),
            F.xxhash64(F.lit(2), before["b"], item).alias("b"),
        )
        return F.concat(names, F.array(name))

    return F.aggregate(items, F.array().cast(f"array<{NODE}>"), longer)


def _positions(baskets: DataFrame, width: int | None) -> DataFrame:
    """A row for each item of each basket, with its node and the node before."""
    named = baskets.withColumn("names", path_names(F.col("prefix")))
    return expand_positions(named, "prefix", width).select(
        *[c for c in baskets.columns if c != "prefix"],
        F.get("names", F.col("pos")).alias("node"),
        F.when(F.col("pos") > 0, F.get("names", F.col("pos") - 1)).alias("parent"),
        "item",
        "pos",
    )


def prefix_tree(compressed: DataFrame, width: int | None = None) -> DataFrame:
    """The tree of merged baskets: ``(node, parent, item, depth, w)``.

    `compressed` is ``(prefix, w)``, and `width` its longest prefix, if known. ``w`` is
    the weight of all baskets that begin with the path; ``depth`` counts from 1, and a
    node of that depth has no parent. Nodes are summed before the shuffle.
    """
    return (
        _positions(compressed, width)
        .groupBy("node")
        .agg(
            F.first("parent").alias("parent"),
            F.first("item").alias("item"),
            (F.first("pos") + 1).alias("depth"),
            F.sum("w").alias("w"),
        )
    )


def tree_paths(tree: DataFrame, ws: Workspace | None = None) -> DataFrame:
    """The items from the root to each node: ``(node, path, w)``.

    Follows the parents, one depth per round.
    """
    ws = ws or Workspace(tree.sparkSession)
    nodes = ws.write("tree", tree)
    above, depth, found = None, 1, None
    while True:
        here = nodes.df.filter(F.col("depth") == depth)
        if above is None:
            paths = here.select("node", F.array("item").alias("path"), "w")
        else:
            before = above.df.select(F.col("node").alias("parent"), F.col("path").alias("_before"))
            met = lookup_join(here, before, "parent", above.rows, NODE_BYTES + 4 * depth, ["node"])
            paths = met.select("node", F.concat("_before", F.array("item")).alias("path"), "w")
        above = ws.write("paths", paths)
        found = above.df if found is None else found.unionByName(above.df)
        if not above.rows:
            return found
        depth += 1


def tree_cells(ws: Workspace, baskets: Table) -> tuple[Table, Table]:
    """The tree as cells, and the baskets that say where the cells' parents are.

    Instead of a name, a node gets a place: the first basket that runs through it, and its
    position there. The first table is ``(b, prefix, places)``, ``places`` being the
    basket of each position's node, and the second ``(item, b, pos, w)``, a cell for each
    node. All ancestors of a cell are found in the one row of its basket, so whoever holds
    the place needs no copy of the path. `baskets` is ``(prefix, w)`` with `width`.
    """
    width = baskets.stats["width"]
    numbered = ws.write(
        "numbered", baskets.spread().select(F.monotonically_increasing_id().alias("b"), "prefix", "w")
    ).df
    # Read again for the places, so it is not written with its names.
    rows = _positions(numbered, width)
    nodes = ws.write(
        "nodes",
        rows.groupBy("node").agg(
            F.min("b").alias("place"),
            F.first("item").alias("item"),
            F.first("pos").alias("pos"),
            F.sum("w").alias("w"),
        ),
    )
    of = nodes.df.select("node", "place")
    placed = lookup_join(rows.select("b", "node", "pos", "item"), of, "node", nodes.rows, NODE_BYTES, ["b"])
    inner = F.array_sort(F.collect_list(F.struct("pos", "item", "place")))
    lines = placed.groupBy("b").agg(inner.alias("line"))
    # Only a basket that some node is placed in is ever looked up.
    used = lines.filter(F.exists("line", lambda x: x["place"] == F.col("b"))).select(
        "b",
        F.transform("line", lambda x: x["item"]).alias("prefix"),
        F.transform("line", lambda x: x["place"]).alias("places"),
    )
    kept = ws.write("places", used, items=F.sum(F.size("prefix")))
    cells = nodes.df.select("item", F.col("place").alias("b"), "pos", "w")
    return kept, Table(cells, nodes.path, nodes.rows)
