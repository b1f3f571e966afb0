"""The entry point: one call, eight strategies, the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from basketweave import plans
from basketweave.workspace import Workspace

ALGORITHMS = (
    "apriori",
    "eclat",
    "fpgrowth",
    "pair_pruned",
    "prefix_array",
    "cells",
    "subsets",
    "builtin",
)
# Names under which the strategies are published.
ALIASES = {"fpgrowth*": "pair_pruned", "fpgrowth_star": "pair_pruned", "nonordfp": "cells"}
DEFAULT_GROUPS = 36


def frequent_itemsets(
    data: DataFrame,
    min_support: int,
    algorithm: str = "pair_pruned",
    num_groups: int = DEFAULT_GROUPS,
    max_len: int | None = None,
    workspace: Workspace | None = None,
    subset_width: int = plans.SUBSET_WIDTH,
    buckets: int | None = None,
) -> DataFrame:
    """Every itemset in at least `min_support` transactions: ``(itemset, k, freq)``.

    `data` has either ``(tid, items)`` or ``(tid, item)`` columns. All algorithms
    return the same rows; `num_groups` concerns `fpgrowth` and `builtin` only,
    `subset_width`, the widest prefix whose subsets are enumerated, `subsets`, and
    `buckets`, into which tid lists are cut, `eclat`. `max_len` bounds the itemsets; all
    but `builtin`, which mines them all first, save work by it.
    Intermediate tables go to `workspace`, by default a new folder under
    ``spark.checkpoint.dir``; the result reads from there.
    """
    if min_support < 1:
        raise ValueError("min_support is a number of transactions and must be at least 1")
    if max_len is not None and max_len < 1:
        raise ValueError("max_len must be at least 1")
    if num_groups < 1:
        raise ValueError("num_groups must be at least 1")
    name = ALIASES.get(algorithm, algorithm)
    if name not in ALGORITHMS:
        raise ValueError(f"unknown algorithm {algorithm!r}, expected one of {ALGORITHMS}")
    ws = workspace or Workspace(data.sparkSession)
    if name == "builtin":
        return plans.mine_builtin(ws, data, min_support, max_len, num_groups)
    if name == "fpgrowth":
        return plans.mine_fpgrowth(ws, data, min_support, max_len, num_groups)
    if name == "subsets":
        return plans.mine_subsets(ws, data, min_support, max_len, subset_width)
    if name == "eclat":
        return plans.mine_eclat(ws, data, min_support, max_len, buckets)
    mine = {
        "apriori": plans.mine_apriori,
        "cells": plans.mine_cells,
        "pair_pruned": plans.mine_pair_pruned,
        "prefix_array": plans.mine_prefix_array,
    }[name]
    return mine(ws, data, min_support, max_len)
