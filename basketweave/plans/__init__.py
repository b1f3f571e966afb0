from basketweave.plans.apriori import mine_apriori
from basketweave.plans.builtin import association_rules_builtin, mine_builtin
from basketweave.plans.cells import mine_cells
from basketweave.plans.eclat import mine_eclat
from basketweave.plans.growth import (
    SUBSET_WIDTH,
    mine_fpgrowth,
    mine_pair_pruned,
    mine_prefix_array,
    mine_subsets,
)

__all__ = [
    "SUBSET_WIDTH",
    "association_rules_builtin",
    "mine_apriori",
    "mine_builtin",
    "mine_cells",
    "mine_eclat",
    "mine_fpgrowth",
    "mine_pair_pruned",
    "mine_prefix_array",
    "mine_subsets",
]
