from kinroll.functions.buckets import declared, filter_buckets, range_filters
from kinroll.functions.terms import TOKEN_SEPARATOR, bucket_counts, side_by_side, term_buckets, terms

__all__ = [
    "TOKEN_SEPARATOR", "bucket_counts", "declared", "filter_buckets", "range_filters", "side_by_side", "term_buckets", "terms",
]
