from kinroll.operators.family import family_counts, family_filter, family_having, family_values, filter_rows
from kinroll.operators.levels import bucket_levels, bucket_tree, chain_levels
from kinroll.operators.poststeps import running
from kinroll.operators.rollup import (
    bucket_pairs,
    chain_rollup,
    heavy_keys,
    lift_to_parents,
    merge_rollups,
    only_live,
    parent_rollup,
)
from kinroll.operators.states import finish_states, merge_bitmaps, merge_states, parent_bitmaps, partial_rollup

__all__ = [
    "bucket_levels", "bucket_pairs", "bucket_tree", "chain_levels", "chain_rollup", "family_counts", "family_filter",
    "family_having", "family_values", "filter_rows", "finish_states", "heavy_keys", "lift_to_parents", "merge_bitmaps",
    "merge_rollups", "merge_states", "only_live", "parent_bitmaps", "parent_rollup", "partial_rollup", "running",
]
