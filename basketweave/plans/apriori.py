"""Level-wise mining: candidates from one level, counted to give the next."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketweave.functions import fits_broadcast
from basketweave.operators.candidates import (
    count_candidates,
    count_candidates_tree,
    extend_occurrences,
    generate_candidates,
    itemset_bytes,
    next_candidates,
    prune_candidates,
)
from basketweave.operators.patterns import count_pairs, pattern_base, project_prefixes
from basketweave.plans.encode import (
    decode,
    empty_itemsets,
    encode_baskets,
    rank_dictionary,
    single_itemsets,
)
from basketweave.workspace import Table, Workspace

# Up to so many candidates of one level, those of the next one are counted with them.
FEW_CANDIDATES = 10_000


def _write_occurrences(ws: Workspace, extended: DataFrame) -> Table:
    """Occurrences that can still grow, equal ones merged."""
    merged = (
        extended.filter(F.size("rest") > 0).groupBy("itemset", "rest").agg(F.sum("w").alias("w"))
    )
    return ws.write("occurrences", merged, width=F.max(F.size("rest")))


def _frequent_rest(held: Table, level: Table, k: int) -> DataFrame:
    """Occurrences of the last level, their rest cut to the items that grew them.

    Any further item must be frequent with the shorter itemset too, so cutting
    before the rows are extended loses nothing, nor does leaving out itemsets that
    a single item grew.
    """
    keep = (
        level.df.groupBy(F.expr("slice(itemset, 2, size(itemset) - 1)").alias("suffix"))
        .agg(F.collect_list(F.element_at("itemset", 1)).alias("keep"))
        .filter(F.size("keep") > 1)
    )
    base = held.spread().select(F.col("itemset").alias("suffix"), F.col("rest").alias("prefix"), "w")
    projected = project_prefixes(base, keep, level.rows, itemset_bytes(k))
    return projected.select(F.col("suffix").alias("itemset"), F.col("prefix").alias("rest"), "w")


def mine_apriori(
    ws: Workspace,
    data: DataFrame,
    min_support: int,
    max_len: int | None = None,
    few: int = FEW_CANDIDATES,
) -> DataFrame:
    """Generate, prune and count candidates, one or two levels at a time.

    Pairs are counted as they stand in the pruned baskets. While the candidates fit the
    broadcast limit they are counted as a tree in one scan of the baskets; up to `few` of
    them are also taken as if they were frequent, and the candidates of the next level
    that follow are counted in the same scan. More candidates than fit are counted by
    extending the occurrences of the level before, which are kept as a table.
    """
    items = rank_dictionary(ws, data, min_support)
    if items is None:
        return empty_itemsets(ws.spark)
    levels = [single_itemsets(items)]
    if max_len == 1:
        return decode(items, levels)

    baskets = encode_baskets(ws, data, items)
    pairs = count_pairs(pattern_base(baskets.spread()), min_support, baskets.stats["width"])
    level = ws.write("level", pairs.select(F.array("left", "right").alias("itemset"), "freq"))
    if level.rows:
        levels.append(level.df)
    # A triple has three pairs, all of them in the level.
    if level.rows > 2 and (max_len is None or max_len > 2):
        near = _candidates(ws, level, 3)
        if fits_broadcast(near.rows, itemset_bytes(3)):
            sizes = [1, items.rows, level.rows]
            levels += _count_trees(ws, baskets, near, sizes, min_support, max_len, few)
        else:
            levels += _extend(ws, baskets, level, near, min_support, max_len)
    ws.drop(baskets)
    return decode(items, levels)


def _candidates(ws: Workspace, level: Table, k: int) -> Table:
    """The pruned candidates of `k` items, written."""
    found = generate_candidates(level.df, level.rows)
    return ws.write("candidates", prune_candidates(found, level.df, level.rows, k - 1))


def _count_trees(
    ws: Workspace,
    baskets: Table,
    near: Table,
    sizes: list[int],
    min_support: int,
    max_len: int | None,
    few: int,
) -> list[DataFrame]:
    """The frequent itemsets from the candidates `near` of three items on.

    `sizes` says how many frequent itemsets of 0, 1 and 2 items there are. What a pruned
    candidate begins with is frequent too, so these bound the nodes of the tree.
    """
    levels, k = [], 3
    while near.rows:
        wanted, rows, longest, nodes = near.df, near.rows, k, [*sizes, near.rows]
        if near.rows <= few and near.rows > k and (max_len is None or k < max_len):
            far = prune_candidates(
                generate_candidates(near.df, near.rows), near.df, near.rows, k
            )
            # Written, as every step of the walk reads them.
            both = ws.write("candidates", near.df.unionByName(far))
            wanted, rows, longest = both.df, both.rows, k + 1
            nodes.append(both.rows - near.rows)
        counts = count_candidates_tree(
            baskets.spread(), wanted, rows, k, longest, min_support, nodes
        )
        level = ws.write("level", counts, last=F.count_if(F.size("itemset") == longest))
        if level.rows:
            levels.append(level.df)
        sizes = nodes[:-1] + [level.stats["last"]]
        k = longest + 1
        if level.stats["last"] < k or (max_len is not None and k > max_len):
            break
        last = Table(level.df.filter(F.size("itemset") == longest), "", level.stats["last"])
        near = _candidates(ws, last, k)
    return levels


def _extend(
    ws: Workspace, baskets: Table, level: Table, near: Table, min_support: int, max_len: int | None
) -> list[DataFrame]:
    """The same by occurrences, each level extending those of the one before."""
    whole = baskets.spread().select(
        F.array().cast("array<int>").alias("itemset"), F.col("prefix").alias("rest"), "w"
    )
    held = _write_occurrences(ws, extend_occurrences(whole, baskets.stats["width"]))
    levels, k, candidates, bound = [], 3, near.df, near.rows
    while bound and held.rows:
        extended = extend_occurrences(_frequent_rest(held, level, k), held.stats["width"])
        before, held = held, _write_occurrences(ws, extended)
        ws.drop(before)
        level = ws.write("level", count_candidates(held.spread(), candidates, min_support, bound, k))
        if level.rows:
            levels.append(level.df)
        k += 1
        # A k-itemset has k subsets of k - 1 items, all of them in the level.
        if level.rows < k or (max_len is not None and k > max_len):
            break
        candidates, bound = next_candidates(ws, level, k)
    ws.drop(held)
    return levels
