from kinroll.plans.relation import Relation
from kinroll.plans.strategy import (
    DEDUP_STRATEGIES,
    plan_shape,
    pushed_filters,
    scan_columns,
    spread,
)

__all__ = ["DEDUP_STRATEGIES", "Relation", "plan_shape", "pushed_filters", "scan_columns", "spread"]
