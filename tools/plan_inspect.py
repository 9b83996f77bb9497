"""Inspection of executed plans, for tests and the plan report.

``executed_shape`` runs a query (collecting it: use on small results) so that
the final adaptive plan can be read.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame  # noqa: E402

from kinroll.plans.strategy import physical_plan  # noqa: E402


def executed_shape(df: DataFrame) -> dict[str, int]:
    """Run ``df`` (collects it: use on small results) and count the exchanges
    of the final adaptive plan; a reused exchange is counted apart."""
    df.collect()
    lines = physical_plan(df).split("== Initial Plan ==")[0].splitlines()
    return {
        "hash_exchanges": sum("Exchange hashpartitioning" in ln and "ReusedExchange" not in ln
                              for ln in lines),
        "reused_exchanges": sum("ReusedExchange" in ln for ln in lines),
        "broadcast_joins": sum("BroadcastHashJoin" in ln for ln in lines),
        "sort_merge_joins": sum("SortMergeJoin" in ln for ln in lines),
        "file_scans": sum("FileScan" in ln for ln in lines),
    }
