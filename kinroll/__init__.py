"""kinroll: parent/child roll-ups on Spark DataFrames."""

from kinroll.functions import bucket_counts, declared, filter_buckets, range_filters, side_by_side, term_buckets, terms
from kinroll.operators import (
    bucket_levels,
    bucket_pairs,
    bucket_tree,
    chain_levels,
    chain_rollup,
    family_counts,
    family_filter,
    family_having,
    family_values,
    filter_rows,
    finish_states,
    heavy_keys,
    lift_to_parents,
    merge_bitmaps,
    merge_rollups,
    merge_states,
    only_live,
    parent_bitmaps,
    parent_rollup,
    partial_rollup,
    running,
)
from kinroll.plans import Relation
from kinroll.session import cut_lineage, ensure_checkpoint_dir, get_session

__all__ = [
    "Relation", "bucket_counts", "bucket_levels", "bucket_pairs", "bucket_tree", "chain_levels", "chain_rollup",
    "cut_lineage", "declared", "ensure_checkpoint_dir", "family_counts", "family_filter", "family_having",
    "family_values", "filter_buckets", "filter_rows", "finish_states", "get_session", "heavy_keys", "lift_to_parents",
    "merge_bitmaps", "merge_rollups", "merge_states", "only_live", "parent_bitmaps", "parent_rollup", "partial_rollup",
    "range_filters", "running", "side_by_side", "term_buckets", "terms",
]
