from basketweave.operators.bitmaps import bitmap_sizes, intersect_bitmap_classes, tid_bitmaps
from basketweave.operators.candidates import (
    count_candidates,
    count_candidates_tree,
    extend_occurrences,
    generate_candidates,
    prune_candidates,
)
from basketweave.operators.counting import (
    compress_transactions,
    frequent_items,
    item_counts,
    item_rank,
    itemset_support,
    prune_transactions,
    transaction_count,
)
from basketweave.operators.matrix import matrix_pairs, pair_matrix
from basketweave.operators.patterns import (
    conditional_item_counts,
    conditional_pattern_base,
    conditional_transactions,
    kept_items,
    pair_counts,
    pattern_base,
    project_prefixes,
)
from basketweave.operators.rules import association_rules
from basketweave.operators.tidlists import (
    intersect_classes,
    intersect_tid_lists,
    tid_list_sizes,
    tid_lists,
)
from basketweave.operators.trees import prefix_tree, tree_paths

__all__ = [
    "association_rules",
    "bitmap_sizes",
    "compress_transactions",
    "conditional_item_counts",
    "conditional_pattern_base",
    "conditional_transactions",
    "count_candidates",
    "count_candidates_tree",
    "extend_occurrences",
    "frequent_items",
    "generate_candidates",
    "intersect_bitmap_classes",
    "intersect_classes",
    "intersect_tid_lists",
    "item_counts",
    "item_rank",
    "itemset_support",
    "kept_items",
    "matrix_pairs",
    "pair_counts",
    "pair_matrix",
    "pattern_base",
    "prefix_tree",
    "project_prefixes",
    "prune_candidates",
    "prune_transactions",
    "tid_bitmaps",
    "tid_list_sizes",
    "tid_lists",
    "transaction_count",
    "tree_paths",
]
