"""Spark ML's own parallel FP-growth, behind the common interface."""

from __future__ import annotations

import itertools
import math

from pyspark.ml.fpm import FPGrowth, FPGrowthModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketweave.operators.counting import prune_transactions
from basketweave.plans.encode import decode, empty_itemsets, rank_dictionary
from basketweave.workspace import Workspace

RULES_SCHEMA = (
    "antecedent ARRAY<STRING>, consequent ARRAY<STRING>, confidence DOUBLE, lift DOUBLE, support DOUBLE"
)

# Items that a basket may have for all its subsets to be mined where only short ones are
# wanted, and the most blocks that wider baskets are cut into.
BLOCK_ITEMS, MOST_BLOCKS = 15, 36


def _baskets(data: DataFrame) -> DataFrame:
    """All transactions as ``(items)``; one without items counts towards N too."""
    if "items" not in data.columns:
        data = data.groupBy("tid").agg(F.collect_set("item").alias("items"))
    kept = F.filter(F.array_distinct("items"), lambda x: x.isNotNull() & (x != ""))
    return data.select(kept.alias("items"))


def fit_builtin(
    data: DataFrame,
    min_support: int,
    num_groups: int | None = None,
    min_confidence: float = 0.0,
    ws: Workspace | None = None,
) -> FPGrowthModel | None:
    """Fit the model at an absolute threshold; None if no itemset can reach it.

    The model takes a ratio and rounds ratio times N up, so half a transaction
    less than `min_support` comes back as exactly `min_support`.
    """
    ws = ws or Workspace(data.sparkSession)
    baskets = ws.write("transactions", _baskets(data))
    if min_support > baskets.rows:
        return None
    mining = FPGrowth(
        itemsCol="items",
        minSupport=(min_support - 0.5) / baskets.rows,
        minConfidence=min_confidence,
    )
    if num_groups is not None:
        mining.setNumPartitions(num_groups)
    return mining.fit(baskets.df)


def _covers(items: int, max_len: int) -> tuple[int, list[list[int]]]:
    """A number of parts for the ranks, and blocks of parts that hold any `max_len` items together."""
    parts = max_len + 2
    while math.comb(parts + 1, max_len) <= MOST_BLOCKS and max_len * -(-items // parts) > BLOCK_ITEMS:
        parts += 1
    return parts, [[*block] for block in itertools.combinations(range(parts), max_len)]


def _coded(i: int, block: list[int], parts: int, items: int) -> Column:
    """The ranks of ``items`` that are in a block, as its own codes."""
    own = F.filter("items", lambda x: (x % parts).isin(block))
    return F.transform(own, lambda x: x.cast("bigint") + i * items)


def mine_builtin(
    ws: Workspace,
    data: DataFrame,
    min_support: int,
    max_len: int | None = None,
    num_groups: int | None = None,
) -> DataFrame:
    """The built-in model's itemsets, mined once and written.

    Infrequent items go before the baskets are built, so the model sees ranks only. It mines
    all lengths, of which there are too many in wide baskets. With `max_len` those are
    therefore cut into blocks of items, such that any `max_len` items are in some block, and
    the blocks are mined side by side under codes of their own; what several blocks hold
    has the same count in each.
    """
    items = rank_dictionary(ws, data, min_support)
    if items is None:
        return empty_itemsets(data.sparkSession)
    pruned = prune_transactions(data, items.df, items.rows, items.row_bytes).select("items")
    baskets = ws.write("transactions", pruned, width=F.max(F.size("items")))
    if max_len is not None and baskets.stats["width"] > max(BLOCK_ITEMS, max_len):
        parts, blocks = _covers(items.rows, max_len)
        cut = F.explode(F.array(*[_coded(i, block, parts, items.rows) for i, block in enumerate(blocks)]))
        before, baskets = baskets, ws.write("blocks", baskets.df.select(cut.alias("items")).filter(F.size("items") > 0))
        ws.drop(before)
    mining = FPGrowth(itemsCol="items", minSupport=(min_support - 0.5) / baskets.rows)
    if num_groups is not None:
        mining.setNumPartitions(num_groups)
    found = mining.fit(baskets.df).freqItemsets
    found = found if max_len is None else found.filter(F.size("items") <= max_len)
    ranks = F.sort_array(F.transform("items", lambda x: (x % items.rows).cast("int")))
    mined = ws.write("itemsets", found.select(ranks.alias("itemset"), "freq").distinct()).df
    return decode(items, [mined])


def association_rules_builtin(
    data: DataFrame,
    min_support: int,
    num_groups: int | None = None,
    min_confidence: float = 0.0,
    workspace: Workspace | None = None,
) -> DataFrame:
    """The built-in model's rules: ``(antecedent, consequent, confidence, lift, support)``.

    The rules read the itemsets several times; a cache makes the model mine them once.
    """
    ws = workspace or Workspace(data.sparkSession)
    model = fit_builtin(data, min_support, num_groups, min_confidence, ws)
    if model is None:
        return empty_rules(data.sparkSession)
    mined = model.freqItemsets.persist()
    rules = model.associationRules.withColumn("antecedent", F.sort_array("antecedent"))
    written = ws.write("rules", rules).df
    mined.unpersist()
    return written


def empty_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], RULES_SCHEMA)
