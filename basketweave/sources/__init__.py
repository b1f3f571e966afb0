from basketweave.sources.transactions import (
    assign_tids,
    explode_items,
    long_rows,
    read_transactions,
    transactions_from_rows,
)
from basketweave.sources.views import BASKET_VIEWS, basket_view
from basketweave.sources.writers import write_itemsets, write_rules

__all__ = [
    "BASKET_VIEWS",
    "assign_tids",
    "basket_view",
    "explode_items",
    "long_rows",
    "read_transactions",
    "transactions_from_rows",
    "write_itemsets",
    "write_rules",
]
