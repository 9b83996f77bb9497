"""Physical-plan choices that are ours to make, and plan inspection.

Everything else (scan pruning, filter pushdown, join choice, partial
aggregation, spill) is left to Catalyst and AQE.
"""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame

# map_side: Spark's partial aggregation removes duplicate (bucket, key) pairs
#   inside each map task before the shuffle; robust to a hot parent key.
# co_locate: hash-partition the raw pairs by parent key, then deduplicate and
#   join in the same stage; one exchange fewer, but a hot key lands whole in
#   one task, so use it only on keys known to be evenly spread.
# prepartitioned: the hits and parents are already partitioned by the key
#   (tables written with ``sources.write_co_located``, bucketed alike); no
#   exchange is added before the join, Spark inserts one only if the input
#   turns out not to be partitioned that way.
# split: hits of heavy parent keys (few, found in a sample or given) take the
#   map_side plan, all others the co_locate plan; the two results, disjoint by
#   parent, are merged per bucket.
DEDUP_STRATEGIES = ("map_side", "co_locate", "prepartitioned", "split")


def check_dedup(dedup: str) -> str:
    if dedup not in DEDUP_STRATEGIES:
        raise ValueError(f"dedup must be one of {DEDUP_STRATEGIES}, got {dedup!r}")
    return dedup


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` for a CPU-heavy narrow step such as text analysis: as it is where
    its scan has a split per core, so wide rows are not shuffled for the step's
    sake (what it yields is); a table of fewer splits, small therefore, is dealt
    out by ``keys``. The rows are the same either way."""
    if df.rdd.getNumPartitions() >= df.sparkSession.sparkContext.defaultParallelism:
        return df
    return df.repartition(*keys)


def _explain(df: DataFrame, mode: str = "simple") -> str:
    """The text ``df.explain(mode)`` prints, captured."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def physical_plan(df: DataFrame) -> str:
    """The physical plan; after an action on ``df`` it is AQE's final plan."""
    return _explain(df)


def plan_shape(df: DataFrame) -> dict[str, int]:
    """Counts of the operators that matter for scale in the physical plan."""
    plan = physical_plan(df)
    return {
        "hash_exchanges": len(re.findall(r"Exchange hashpartitioning", plan)),
        "single_partition_exchanges": len(re.findall(r"Exchange SinglePartition", plan)),
        "broadcast_joins": len(re.findall(r"BroadcastHashJoin", plan)),
        "sort_merge_joins": len(re.findall(r"SortMergeJoin", plan)),
        "cartesian": len(re.findall(r"CartesianProduct|BroadcastNestedLoopJoin", plan)),
        "python_udfs": len(re.findall(r"ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas", plan)),
    }


def scan_columns(df: DataFrame) -> list[list[str]]:
    """Columns read by each file scan (``ReadSchema``), to check pruning."""
    out = []
    for m in re.finditer(r"ReadSchema: struct<([^>]*)>", physical_plan(df)):
        out.append([f.split(":")[0] for f in m.group(1).split(",") if f])
    return out


def pushed_filters(df: DataFrame) -> list[str]:
    return re.findall(r"PushedFilters: \[([^\]]*)\]", physical_plan(df))
