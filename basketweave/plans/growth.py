"""Pattern growth over pattern bases, one suffix length per round.

A round counts the items of every pattern base (the next itemsets), drops the
infrequent ones from the prefixes and turns each base into those of the suffixes
one item longer, until nothing is left. With `finish_width`, which is off unless it
is given, bases without a wider prefix leave the rounds early: the subsets of their
prefixes are counted directly, in one pass.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketweave.functions import (
    expand_positions,
    fits_broadcast,
    lookup_join,
    once,
    project,
    subsets,
)
from basketweave.operators.patterns import (
    conditional_pattern_base,
    conditional_transactions,
    count_pairs,
    extension_counts,
    ordered_items,
    pattern_base,
    project_prefixes,
)
from basketweave.plans.encode import (
    decode,
    empty_itemsets,
    encode_baskets,
    rank_dictionary,
    single_itemsets,
)
from basketweave.workspace import Table, Workspace

# The subset strategy enumerates all bases up to this width.
SUBSET_WIDTH = 14
# Subsets are summed as masks for up to so many items, each of which is a step; of more,
# narrow prefixes have few. And how many items go before equal masks merge.
MASK_ITEMS, MERGE_ITEMS = 12, 3
# Merged baskets up to which a group is one task's work; of more it is dealt to pieces.
GROUP_BASKETS = 32_768


def _write_base(ws: Workspace, base: DataFrame) -> Table:
    """Write a pattern base, observing its longest prefix."""
    return ws.write("base", base, width=F.max(F.size("prefix")))


def _is_small(width: int, finish_width: int | None) -> bool:
    return finish_width is not None and width <= finish_width


def superset_sums(masks: DataFrame, key: list[str], items: int) -> DataFrame:
    """For each set the weight of all sets that hold it: ``(*key, high, low, w)`` to the same.

    Sets of up to `items` items are two masks, ``low`` for the first half of the items and
    ``high`` for the others. Item by item a set that has the item also counts for the set
    without it, and equal sets merge on the way, so the subsets of a row are never listed
    and what many rows have in common is passed on once. While the items of one half go,
    the other half of a set does not change: partitioned by that, all steps of a half are
    local, and there are two shuffles however many items there are.
    """
    half = -(-items // 2)
    for part, other, bits in (("low", "high", half), ("high", "low", items - half)):
        masks = masks.groupBy(*key, "high", "low").agg(F.sum("w").alias("w"))
        masks = masks.repartition(*key, other)
        for bit in range(bits):
            has = F.getbit(part, F.lit(bit)) == 1
            less = F.col(part).bitwiseXOR(F.lit(1 << bit))
            both = F.when(has, F.array(F.col(part), less)).otherwise(F.array(part))
            masks = masks.select(*key, other, F.explode(both).alias(part), "w")
            if bit % MERGE_ITEMS == MERGE_ITEMS - 1 or bit == bits - 1:
                masks = masks.groupBy(*key, "high", "low").agg(F.sum("w").alias("w"))
    return masks


def _mask(prefix: str, start: int, stop: int) -> Column:
    """The items of an array from `start` to `stop` as bits, the first one lowest."""
    own = F.filter(prefix, lambda x: (x >= start) & (x < stop))
    return F.aggregate(
        own,
        F.lit(0),
        lambda mask, x: mask.bitwiseOR(F.call_function("shiftleft", F.lit(1), x - start)),
    )


def _count_masks(base: DataFrame, min_support: int, shortest: int, items: int) -> DataFrame:
    """`_count_subsets` by superset sums, for ranks below `items`."""
    half = -(-items // 2)
    coded = base.select("suffix", _mask("prefix", 0, half).alias("low"), _mask("prefix", half, items).alias("high"), "w")
    frequent = superset_sums(coded, ["suffix"], items).filter(F.col("w") >= min_support)

    def held(mask: str, n: int) -> Column:
        """The bits of a mask."""
        if not n:
            return F.array().cast("array<int>")
        return F.filter(F.sequence(F.lit(0), F.lit(n - 1)), lambda bit: F.getbit(mask, bit) == 1)

    bits = F.concat(held("low", half), held("high", items - half))
    ranks = F.transform(bits, lambda x, i: F.when(i < F.bit_count("low"), x).otherwise(x + half))
    found = frequent.select(ranks.alias("found"), "suffix", F.col("w").alias("freq"))
    return found.filter(F.size("found") >= shortest).select(
        F.concat("found", "suffix").alias("itemset"), "freq"
    )


def _count_subsets(
    base: DataFrame, min_support: int, shortest: int, longest: int | None, items: int | None = None
) -> DataFrame:
    """Frequent itemsets among the prefix subsets of at least `shortest` items.

    With no `longest`, and no more than MASK_ITEMS `items` in all, they are summed as bit
    masks; otherwise the subsets of each prefix are listed, up to `longest` items.
    """
    if longest is None and items is not None and items <= MASK_ITEMS:
        return _count_masks(base.filter(F.size("prefix") >= shortest), min_support, shortest, items)
    found = F.filter(subsets(F.col("prefix"), longest), lambda s: F.size(s) >= shortest)
    return (
        base.filter(F.size("prefix") >= shortest)
        .select(F.explode(found).alias("found"), "suffix", "w")
        .groupBy(F.concat("found", "suffix").alias("itemset"))
        .agg(F.sum("w").alias("freq"))
        .filter(F.col("freq") >= min_support)
    )


def _keep_bytes(k: int, kept: int, suffixes: int) -> int:
    """The size of one suffix with its kept items, of `kept` for all `suffixes`."""
    return 100 + 4 * k + 4 * -(-kept // max(suffixes, 1))


def _write_extensions(ws: Workspace, base: DataFrame, min_support: int) -> Table:
    """The frequent items of each suffix with their counts: ``(suffix, keep, freqs, width)``.

    One row per suffix; one that keeps a single item cannot grow further.
    """
    grows = F.size("keep") > 1
    return ws.write(
        "counts",
        extension_counts(base, min_support)
        .groupBy("suffix")
        .agg(ordered_items("item", "freq").alias("found"), F.max("width").alias("width"))
        .select(
            "suffix",
            F.transform("found", lambda x: x["item"]).alias("keep"),
            F.transform("found", lambda x: x["freq"]).alias("freqs"),
            "width",
        ),
        grows=F.count_if(grows),
        kept=F.sum(F.when(grows, F.size("keep"))),
        width_left=F.max(F.when(grows, F.col("width"))),
    )


def _extended(counts: Table) -> DataFrame:
    """The itemsets that `_write_extensions` has counted."""
    found = F.explode(F.arrays_zip("keep", "freqs")).alias("found")
    return counts.df.select("suffix", found).select(
        F.concat(F.array("found.keep"), "suffix").alias("itemset"), F.col("found.freqs").alias("freq")
    )


def _growing(counts: Table) -> DataFrame:
    return counts.df.filter(F.size("keep") > 1).select("suffix", "keep")


def grow(
    ws: Workspace,
    base: Table,
    k: int,
    min_support: int,
    max_len: int | None = None,
    finish_width: int | None = None,
    items: int | None = None,
) -> list[DataFrame]:
    """Frequent itemsets of more than `k` items from the bases of all k-suffixes.

    `items` is the number of all frequent items, if known.
    """
    levels: list[DataFrame] = []
    while base.rows:
        counts = _write_extensions(ws, base.spread(), min_support)
        stats = counts.stats
        if counts.rows:
            levels.append(_extended(counts))
        k += 1
        if not stats["grows"] or (max_len is not None and k >= max_len):
            break

        projected = project_prefixes(
            base.spread(),
            _growing(counts),
            stats["grows"],
            _keep_bytes(k, stats["kept"], stats["grows"]),
            local_order=True,
        )
        if _is_small(stats["width_left"], finish_width):
            longest = None if max_len is None else max_len - k + 1
            levels.append(ws.write("direct", _count_subsets(projected, min_support, 2, longest, items)).df)
            break
        before, base = base, _write_base(
            ws, conditional_pattern_base(projected, base.stats["width"])
        )
        ws.drop(before)
    ws.drop(base)
    return levels


def _mine(ws, data, min_support, max_len, grow_rest, finish_width) -> DataFrame:
    """Shared outline: dictionary, merged baskets, their longer itemsets, names.

    `grow_rest` takes the baskets unless their subsets can be counted directly.
    """
    items = rank_dictionary(ws, data, min_support)
    if items is None:
        return empty_itemsets(ws.spark)
    levels = [single_itemsets(items)]
    if max_len is None or max_len > 1:
        baskets = encode_baskets(ws, data, items)
        stats = baskets.stats
        if _is_small(stats["width"], finish_width):
            direct = _count_subsets(pattern_base(baskets.spread()), min_support, 2, max_len, items.rows)
            levels.append(ws.write("direct", direct).df)
        else:
            levels += grow_rest(baskets, items.rows)
        ws.drop(baskets)
    return decode(items, levels)


def mine_prefix_array(
    ws: Workspace,
    data: DataFrame,
    min_support: int,
    max_len: int | None = None,
    finish_width: int | None = None,
) -> DataFrame:
    """Growth keyed by suffix over merged rank arrays."""

    def grow_rest(baskets: Table, items: int) -> list[DataFrame]:
        first = conditional_pattern_base(pattern_base(baskets.spread()), baskets.stats["width"])
        base = _write_base(ws, first)
        return grow(ws, base, 1, min_support, max_len, finish_width, items)

    return _mine(ws, data, min_support, max_len, grow_rest, finish_width)


def grow_in_group(base: DataFrame, min_support: int, owner: Column | None = None) -> DataFrame:
    """One round of growth that stays within each group: the bases of longer suffixes.

    `base` is ``(grp, suffix, prefix, w)``, and so is the result, for the frequent
    suffixes that are one item longer. Every step groups by ``grp`` and more, so a frame
    that is partitioned by ``grp`` is neither shuffled nor joined: the counts of a base's
    items, and then the items worth keeping, stand beside its rows as window aggregates.
    Rows whose prefix becomes empty stay, so that the weights of a suffix sum to its
    count. `owner` restricts the new items.
    """
    rows = base.select("grp", "suffix", F.posexplode("prefix").alias("pos", "item"), "prefix", "w")
    of_item = W.partitionBy("grp", "suffix", "item")
    counted = rows.withColumn("freq", F.sum("w").over(of_item)).filter(F.col("freq") >= min_support)
    # Sorted by item already, so the second window needs no further sort.
    kept = counted.withColumn("keep", F.collect_set("item").over(W.partitionBy("grp", "suffix")))
    if owner is not None:
        kept = kept.filter(owner)
    shorter = project(F.slice("prefix", F.lit(1), F.col("pos")), F.col("keep"))
    return (
        kept.select("grp", F.concat(F.array("item"), "suffix").alias("suffix"), shorter.alias("prefix"), "w")
        .groupBy("grp", "suffix", "prefix")
        .agg(F.sum("w").alias("w"))
    )


def _cut_in_place(rows: DataFrame) -> DataFrame:
    """``(shard, suffix, pos, item, prefix, w)`` to the bases of the longer suffixes, by shard."""
    return (
        rows.filter("pos > 0")
        .select(
            "shard",
            F.concat(F.array("item"), "suffix").alias("suffix"),
            F.slice("prefix", F.lit(1), F.col("pos")).alias("prefix"),
            "w",
        )
        .groupBy("shard", "suffix", "prefix")
        .agg(F.sum("w").alias("w"))
    )


def _grow_pieces(
    ws: Workspace,
    baskets: Table,
    items: int,
    pieces: int,
    min_support: int,
    max_len: int | None,
    num_groups: int,
    finish_width: int | None,
) -> list[DataFrame]:
    """The rounds of `mine_fpgrowth` where a group is more than one task's work.

    The rows of a group are dealt to `pieces` by their prefixes and stay where they are. A
    piece's counts are not final, so a round sums them over all pieces and tells each what
    its suffixes keep; the rows are shuffled again only if that is too much to broadcast.
    """
    buckets = min(num_groups, items) * pieces
    piece = F.pmod(F.xxhash64("prefix"), F.lit(pieces)).cast("int")
    sharded = (
        conditional_transactions(baskets.spread(), num_groups, array="prefix")
        .select("grp", (F.col("grp") * pieces + piece).alias("shard"), "prefix", "w")
        .repartition(buckets, "shard")
        .withColumn("suffix", F.array().cast("array<int>"))
    )
    owned = sharded.select("*", F.posexplode("prefix").alias("pos", "item")).filter(
        F.col("item") % num_groups == F.col("grp")
    )
    base = ws.write_bucketed("base", _cut_in_place(owned), "shard", buckets)
    k, levels = 1, []
    while base.rows:
        counts = _write_extensions(ws, base.df, min_support)
        stats = counts.stats
        if counts.rows:
            levels.append(_extended(counts))
        k += 1
        if not stats["grows"] or (max_len is not None and k >= max_len):
            break
        row_bytes = _keep_bytes(k, stats["kept"], stats["grows"])
        kept = lookup_join(base.df, _growing(counts), "suffix", stats["grows"], row_bytes, ["prefix"])
        projected = kept.select("shard", "suffix", once(project(F.col("keep"), F.col("prefix"))).alias("prefix"), "w")
        if _is_small(stats["width_left"], finish_width):
            longest = None if max_len is None else max_len - k + 1
            levels.append(ws.write("direct", _count_subsets(projected, min_support, 2, longest, items)).df)
            break
        if not fits_broadcast(stats["grows"], row_bytes):
            projected = projected.repartition(buckets, "shard")
        longer = _cut_in_place(projected.select("*", F.posexplode("prefix").alias("pos", "item")))
        before, base = base, ws.write_bucketed("base", longer, "shard", buckets)
        ws.drop(before)
    ws.drop(base)
    return levels


def mine_fpgrowth(
    ws: Workspace,
    data: DataFrame,
    min_support: int,
    max_len: int | None = None,
    num_groups: int = 36,
    finish_width: int | None = None,
) -> DataFrame:
    """Growth sharded by item group: a group grows only the suffixes it owns.

    Baskets are shuffled once, cut for each group to the longest prefix that it needs.
    From then on a group's rows stay where they are: each round is one job from one table
    bucketed by group to the next, without an exchange. Each task holds whole groups, so
    the groups should be many more than the tasks; the other growth strategies deal rows
    by suffix instead and split hot ones. With more than GROUP_BASKETS merged baskets a
    group is dealt to several tasks, and only its counts leave them.
    """

    def grow_rest(baskets: Table, items: int) -> list[DataFrame]:
        pieces = -(-baskets.rows // GROUP_BASKETS)
        if pieces > 1:
            return _grow_pieces(ws, baskets, items, pieces, min_support, max_len, num_groups, finish_width)
        tasks = int(ws.spark.conf.get("spark.sql.shuffle.partitions"))
        buckets = max(1, min(num_groups, tasks))
        width = F.max(F.size("prefix"))
        sharded = (
            conditional_transactions(baskets.spread(), num_groups, array="prefix")
            .withColumn("suffix", F.array().cast("array<int>"))
            .repartition(buckets, "grp")
            .groupBy("grp", "suffix", "prefix")
            .agg(F.sum("w").alias("w"))
        )
        # A single item is frequent; only what is longer is found here.
        owner = F.col("item") % num_groups == F.col("grp")
        base = grow_in_group(sharded, 1, owner)
        rounds = [ws.write_bucketed("base", base, "grp", buckets, width=width)]
        k, parts = 1, []
        while rounds[-1].stats["width"] and (max_len is None or k < max_len):
            if _is_small(rounds[-1].stats["width"], finish_width):
                longest = None if max_len is None else max_len - k
                parts.append(_count_subsets(rounds[-1].df, min_support, 1, longest, items))
                break
            base = grow_in_group(rounds[-1].df, min_support)
            rounds.append(ws.write_bucketed("base", base, "grp", buckets, width=width))
            k += 1
        for table in rounds[1:]:
            counts = table.df.groupBy("grp", "suffix").agg(F.sum("w").alias("freq"))
            parts.append(counts.select(F.col("suffix").alias("itemset"), "freq"))
        found = [ws.write("itemsets", reduce(DataFrame.unionByName, parts)).df] if parts else []
        for table in rounds:
            ws.drop(table)
        return found

    return _mine(ws, data, min_support, max_len, grow_rest, finish_width)


def mine_subsets(
    ws: Workspace,
    data: DataFrame,
    min_support: int,
    max_len: int | None = None,
    subset_width: int = SUBSET_WIDTH,
) -> DataFrame:
    """Sum the weights of the subsets of all prefixes.

    With up to MASK_ITEMS frequent items and no `max_len`, prefixes are bit masks, merged
    and summed over their supersets item by item. Exponential in the prefix length, so bases are enumerated only once none is
    wider than `subset_width`; until then they grow by one suffix item.
    """
    return mine_prefix_array(ws, data, min_support, max_len, subset_width)


def mine_pair_pruned(
    ws: Workspace,
    data: DataFrame,
    min_support: int,
    max_len: int | None = None,
    finish_width: int | None = None,
) -> DataFrame:
    """Growth where pair counts decide which items enter a pattern base.

    Counting the pairs inside the bases of one round yields the itemsets two
    items longer and, for every suffix of the next round, the items worth
    keeping. The next bases are therefore pruned before they are shuffled and
    need no counting pass of their own.
    """

    def grow_rest(baskets: Table, items: int) -> list[DataFrame]:
        levels: list[DataFrame] = []
        base = Table(pattern_base(baskets.df), "", baskets.rows, baskets.stats)
        k = 0
        while base.rows:
            stats = base.stats
            if k and _is_small(stats["width"], finish_width):
                longest = None if max_len is None else max_len - k
                direct = _count_subsets(base.spread(), min_support, 2, longest, items)
                levels.append(ws.write("direct", direct).df)
                break
            pairs = ws.write("pairs", count_pairs(base.spread(), min_support, stats["width"]))
            if not pairs.rows:
                break
            levels.append(
                pairs.df.select(
                    F.concat(F.array("left", "right"), "suffix").alias("itemset"), "freq"
                )
            )
            k += 1
            if max_len is not None and k + 1 >= max_len:
                break
            before, base = base, _write_base(ws, _pruned_bases(ws, base, pairs, k))
            ws.drop(before)
        ws.drop(base)
        return levels

    return _mine(ws, data, min_support, max_len, grow_rest, finish_width)


def _pruned_bases(ws: Workspace, base: Table, pairs: Table, k: int) -> DataFrame:
    """The bases of the k-item suffixes, holding the items of frequent pairs only.

    A suffix with one kept item has no further pair and gets no base.
    """
    keep = (
        pairs.df.groupBy(F.concat(F.array("right"), "suffix").alias("suffix"))
        .agg(F.collect_list("left").alias("keep"))
        .filter(F.size("keep") > 1)
    )
    suffixes = pairs.rows
    if not fits_broadcast(suffixes, _keep_bytes(k, 1, 1)):
        written = ws.write("keep", keep)
        keep, suffixes = written.df, written.rows
    rows = (
        expand_positions(base.spread(), "prefix", base.stats["width"])
        .filter("pos > 1")
        .select(
            F.concat(F.array("item"), "suffix").alias("suffix"),
            F.slice("prefix", F.lit(1), F.col("pos")).alias("prefix"),
            F.xxhash64("prefix").alias("whole"),
            "w",
        )
    )
    row_bytes = _keep_bytes(k, pairs.rows, max(suffixes, 1))
    return (
        lookup_join(rows, keep, "suffix", suffixes, row_bytes, salt_on=["whole"])
        .select("suffix", once(project(F.col("prefix"), F.col("keep"))).alias("prefix"), "w")
        .filter(F.size("prefix") > 1)
        .groupBy("suffix", "prefix")
        .agg(F.sum("w").alias("w"))
    )
