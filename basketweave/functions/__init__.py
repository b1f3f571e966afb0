from basketweave.functions.arrays import expand_positions, once, project, subsets, without_each
from basketweave.functions.joins import fits_broadcast, lookup_join
from basketweave.functions.numbering import dense_numbers

__all__ = [
    "dense_numbers",
    "expand_positions",
    "fits_broadcast",
    "lookup_join",
    "once",
    "project",
    "subsets",
    "without_each",
]
