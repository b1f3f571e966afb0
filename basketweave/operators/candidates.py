"""Level-wise candidate generation, pruning and counting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketweave.functions import expand_positions, fits_broadcast, lookup_join, without_each
from basketweave.workspace import Table, Workspace

# A group of itemsets with a common stem is paired in blocks of this many.
PAIR_BLOCK = 5000
# Size of a child in a node of the candidate tree.
CHILD_BYTES = 4


def itemset_bytes(k: int) -> int:
    """Estimated size in memory of one k-itemset of ranks."""
    return 80 + 4 * k


def generate_candidates(level: DataFrame, rows: int | None = None) -> DataFrame:
    """Candidate k-itemsets from the frequent (k-1)-itemsets: ``(itemset)``.

    Two itemsets that share all but their last item are joined. A stem with many
    itemsets is cut into blocks and each pair of blocks is joined on its own, so
    no task holds the whole group. `rows` is the size of `level`, if known.
    """
    parts = level.select(
        F.expr("slice(itemset, 1, size(itemset) - 1)").alias("stem"),
        F.element_at("itemset", -1).alias("last"),
    )
    if rows is not None and rows <= PAIR_BLOCK:
        left = parts.withColumnRenamed("last", "a")
        right = parts.withColumnRenamed("last", "b")
        pairs = left.join(right, "stem").filter("a < b")
    else:
        hot = (
            parts.groupBy("stem")
            .agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > PAIR_BLOCK)
            .select("stem", F.ceil(F.col("n") / PAIR_BLOCK).cast("int").alias("cut"))
        )
        # At most rows / PAIR_BLOCK stems are that large.
        if rows is not None and fits_broadcast(rows // PAIR_BLOCK, 128):
            hot = F.broadcast(hot)
        cut = F.coalesce(F.col("cut"), F.lit(1))
        blocks = (
            parts.join(hot, "stem", "left")
            .withColumn("own", F.pmod(F.xxhash64("last"), cut).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), cut - 1)))
        )
        left = blocks.select(
            "stem", F.col("own").alias("i"), F.col("other").alias("j"), F.col("last").alias("a")
        )
        right = blocks.select(
            "stem", F.col("other").alias("i"), F.col("own").alias("j"), F.col("last").alias("b")
        )
        pairs = left.join(right, ["stem", "i", "j"]).filter("a < b")
    return pairs.select(F.concat("stem", F.array("a", "b")).alias("itemset"))


def prune_candidates(
    candidates: DataFrame, level: DataFrame, level_rows: int | None = None, k: int | None = None
) -> DataFrame:
    """Keep a candidate only if all its (k-1)-subsets are in `level`."""
    parts = candidates.select("itemset", F.explode(without_each(F.col("itemset"))).alias("part"))
    known = level.select(F.col("itemset").alias("part"))
    if level_rows is None:
        held = parts.join(known, "part", "left_semi")
    else:
        held = lookup_join(
            parts, known, "part", level_rows, itemset_bytes(k or 8), ["itemset"], "left_semi"
        )
    return (
        held.groupBy("itemset")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") == F.size("itemset"))
        .select("itemset")
    )


def next_candidates(ws: Workspace, level: Table, k: int) -> tuple[DataFrame, int]:
    """Pruned candidates of `k` items from a written level, and a bound on their number.

    A small level's candidates are left to the plan that uses them, bounded by the
    pairs there are; those of a larger one are written and counted.
    """
    found = prune_candidates(generate_candidates(level.df, level.rows), level.df, level.rows, k - 1)
    bound = level.rows * (level.rows - 1) // 2
    if fits_broadcast(bound, itemset_bytes(k)):
        return found, bound
    written = ws.write("candidates", found)
    return written.df, written.rows


def extend_occurrences(occurrences: DataFrame, width: int | None = None) -> DataFrame:
    """Every occurrence with each further item of its transaction put in front.

    ``(itemset, rest, w)``: `rest` holds the items of the transaction that rank
    before the whole itemset, `w` how many transactions the row stands for.
    """
    return expand_positions(occurrences, "rest", width).select(
        F.concat(F.array("item"), "itemset").alias("itemset"),
        F.slice("rest", F.lit(1), F.col("pos")).alias("rest"),
        "w",
    )


def count_candidates(
    occurrences: DataFrame,
    candidates: DataFrame,
    min_support: int = 1,
    candidate_rows: int | None = None,
    k: int | None = None,
) -> DataFrame:
    """How many transactions hold each candidate: ``(itemset, freq)``.

    `occurrences` are those of the (k-1)-itemsets. Candidates small enough to
    broadcast filter the extended rows before they are counted; otherwise the
    rows are counted first and only the counts are shuffled to the candidates.
    """
    grown = occurrences.select(F.explode("rest").alias("item"), "itemset", "w").select(
        F.concat(F.array("item"), "itemset").alias("itemset"), "w"
    )
    first = candidate_rows is not None and fits_broadcast(candidate_rows, itemset_bytes(k or 8))
    if first:
        grown = grown.join(F.broadcast(candidates), "itemset", "left_semi")
    counts = grown.groupBy("itemset").agg(F.sum("w").alias("freq"))
    counts = counts.filter(F.col("freq") >= min_support)
    return counts if first else counts.join(candidates, "itemset", "left_semi")


def count_candidates_tree(
    baskets: DataFrame,
    candidates: DataFrame,
    candidate_rows: int,
    shortest: int,
    longest: int,
    min_support: int = 1,
    node_rows: list[int] | None = None,
) -> DataFrame:
    """How many transactions hold each candidate: ``(itemset, freq)``, in one scan.

    `baskets` are ``(prefix, w)`` and the candidates have `shortest` to `longest` items,
    in the order of the baskets. The candidates are a tree: the items that may follow each
    beginning. A basket walks down from the root and meets, of what is left of it, only
    the children of the node it has reached, so its subsets are never listed, and only
    those that leave enough of it for the shortest candidate. A row that
    reaches a candidate counts it and goes on. A level of the tree is broadcast if its nodes
    fit the limit: `node_rows` bounds the beginnings of 0, 1, ..., `longest` items; without
    it there are taken to be `candidate_rows` of each.
    """
    if node_rows is None:
        node_rows = [candidate_rows] * (longest + 1)
    rows = baskets.select("prefix", "w", F.lit(0).alias("at"), F.array().cast("array<int>").alias("itemset"))
    rows = rows.filter(F.size("prefix") >= shortest)
    nothing = F.array().cast("array<int>")
    for depth in range(longest):
        node = F.slice("itemset", F.lit(1), F.lit(depth)).alias("itemset")
        nodes = (
            candidates.filter(F.size("itemset") > depth)
            .select(node, F.col("itemset")[depth].alias("next"))
            .groupBy("itemset")
            .agg(F.collect_set("next").alias("children"))
        )
        own = max(1, node_rows[depth])
        node_bytes = itemset_bytes(depth) + CHILD_BYTES * -(-node_rows[depth + 1] // own)
        met = lookup_join(rows, nodes, "itemset", own, node_bytes, ["prefix"], "left")
        # What is left of the basket; nothing once the row has stopped to count.
        needed = max(0, shortest - depth - 1)
        rest = F.slice("prefix", F.col("at") + 1, F.size("prefix") - F.col("at") - needed)
        left = F.when(F.col("at") >= 0, rest)
        children = F.coalesce(F.array_intersect(left, F.col("children")), nothing)
        if depth >= shortest:
            children = F.concat(F.array(F.lit(None).cast("int")), children)
        stopped = F.col("item").isNull()
        rows = met.withColumn("item", F.explode(children)).select(
            "prefix",
            "w",
            F.when(stopped, -1).otherwise(F.array_position("prefix", F.col("item"))).cast("int").alias("at"),
            F.when(stopped, F.col("itemset")).otherwise(F.concat("itemset", F.array("item"))).alias("itemset"),
        )
    counts = rows.groupBy("itemset").agg(F.sum("w").alias("freq")).filter(F.col("freq") >= min_support)
    known = candidates.select("itemset")
    return lookup_join(
        counts, known, "itemset", candidate_rows, itemset_bytes(longest), ["freq"], "left_semi"
    )
