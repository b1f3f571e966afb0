"""Frequent itemsets and association rules as Spark jobs."""

from basketweave.api import ALGORITHMS, frequent_itemsets
from basketweave.operators import association_rules, itemset_support, transaction_count
from basketweave.plans import association_rules_builtin
from basketweave.sources import (
    read_transactions,
    transactions_from_rows,
    write_itemsets,
    write_rules,
)
from basketweave.workspace import Workspace

__all__ = [
    "ALGORITHMS",
    "Workspace",
    "association_rules",
    "association_rules_builtin",
    "frequent_itemsets",
    "itemset_support",
    "read_transactions",
    "transaction_count",
    "transactions_from_rows",
    "write_itemsets",
    "write_rules",
]
