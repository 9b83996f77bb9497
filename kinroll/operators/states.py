"""Roll-ups whose results can be merged: mergeable states, and parent-id bitmaps.

A finished average, distinct count or percentile of a shard cannot be merged
with another's. ``partial_rollup`` therefore returns, per bucket and
sub-aggregation, a **state** (a struct) that can, ``merge_states`` combines the
states of any number of parts, and ``finish_states`` turns them into values:

| function | state | merged by |
| --- | --- | --- |
| ``count``, ``sum``, ``min``, ``max`` | the value | ``sum``, ``sum``, ``min``, ``max`` |
| ``avg`` (a double) | sum and count | sums |
| ``var_pop``, ``var_samp``, ``stddev_pop``, ``stddev_samp`` | count, mean, squared deviations | the parts' deviations and those of their means |
| ``approx_count_distinct`` | HyperLogLog sketch, 2^14 registers (error 0.8 %) | union of sketches |
| ``percentile`` (with its fraction) | KLL sketch, k = 800 (rank error 0.4 %) | union of sketches |

What a state is, is written in its column's metadata, which Parquet keeps: parts
may come from other jobs. All parts must be disjoint **by parent key**, as for
``merge_rollups``. Where runs may overlap, ``parent_bitmaps`` keeps the ids of a
bucket's parents as compressed bitmaps: merged, they give the exact count, and
how many parents came more than once.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinroll.operators.rollup import _check_by, _named, lift_to_parents, parent_rollup
from kinroll.plans.relation import Relation

VALUES = {"count": "sum", "sum": "sum", "min": "min", "max": "max"}
MOMENTS = ("var_pop", "var_samp", "stddev_pop", "stddev_samp")
HLL_LG_K = 14
KLL_K = 800
STATE = "kinroll.state"
PARTS = "__kr_part"

StateSpec = tuple


def _check_spec(name: str, spec) -> tuple[str, str, float | None]:
    kinds = (*VALUES, "avg", *MOMENTS, "approx_count_distinct", "percentile")
    if not isinstance(spec, tuple) or len(spec) not in (2, 3) or spec[0] not in kinds or not isinstance(spec[1], str):
        raise TypeError(f"state {name!r} must be (function, SQL expression) with the function one of {sorted(kinds)}")
    fraction = spec[2] if len(spec) == 3 else None
    if (spec[0] == "percentile") != (fraction is not None):
        raise TypeError(f"state {name!r}: a fraction belongs to percentile, and to it alone")
    if fraction is not None and not 0 <= fraction <= 1:
        raise ValueError(f"state {name!r}: the fraction must be between 0 and 1")
    return spec[0], spec[1], fraction


def _inputs(kind: str, expr: str) -> dict[str, object]:
    """Fields of the state, as sub-aggregations of a roll-up."""
    if kind in VALUES:
        return {"value": (kind, expr)}
    if kind == "avg":
        return {"total": ("sum", expr), "n": ("count", expr)}
    if kind in MOMENTS:
        return {"n": f"count({expr})", "mean": f"avg(CAST({expr} AS DOUBLE))", "m2": f"var_pop(CAST({expr} AS DOUBLE))"}
    if kind == "approx_count_distinct":
        return {"sketch": f"hll_sketch_agg({expr}, {HLL_LG_K})"}
    return {"sketch": f"kll_sketch_agg_double(CAST({expr} AS DOUBLE), {KLL_K})"}


def partial_rollup(hits: DataFrame, relation: Relation, by: Sequence[str] | str = (), aggs: Mapping[str, StateSpec] | None = None,
                   *, dedup: str = "map_side", count_name: str = "doc_count", child_count: str | None = None) -> DataFrame:
    """``parent_rollup`` with states for sub-results: ``(by…, doc_count,
    child_count?, states…)``. Two numbers are mergeable as they are."""
    by = _check_by(hits, by)
    specs = {n: _check_spec(n, s) for n, s in (aggs or {}).items()}
    fields = {(n, f): a for n, (kind, expr, _) in specs.items() for f, a in _inputs(kind, expr).items()}
    private = {key: f"__kr_state_{i}" for i, key in enumerate(fields)}
    flat = parent_rollup(hits, relation, by, {private[k]: a for k, a in fields.items()}, dedup=dedup,
                         count_name=count_name, child_count=child_count)
    states = []
    for name, (kind, expr, fraction) in specs.items():
        parts = [F.col(private[name, f]).alias(f) for f in _inputs(kind, expr)]
        if kind in MOMENTS:
            parts[2] = (F.col(private[name, "m2"]) * F.col(private[name, "n"])).alias("m2")
        states.append(F.struct(*parts).alias(name, metadata={STATE: {"kind": kind, "expr": expr, **({"fraction": fraction} if fraction is not None else {})}}))
    counts = [count_name, *([child_count] if child_count else [])]
    return flat.select(*_named(*by, *counts), *states)


def _states_of(part: DataFrame) -> dict[str, dict]:
    return {f.name: f.metadata[STATE] for f in part.schema if STATE in (f.metadata or {})}


def merge_states(parts: Iterable[DataFrame], by: Sequence[str] | str = ()) -> DataFrame:
    """States of parts that are disjoint by parent key, combined per bucket; the
    result can be merged again. Every other number column is summed."""
    parts = list(parts)
    if not parts:
        raise ValueError("nothing to merge")
    by = [by] if isinstance(by, str) else list(by)
    kinds = _states_of(parts[0])
    if any(_states_of(p) != kinds or sorted(p.columns) != sorted(parts[0].columns) for p in parts[1:]):
        raise ValueError("the parts hold different states")
    counts = [c for c in parts[0].columns if c not in by and c not in kinds]
    union = reduce(DataFrame.unionByName, parts)
    moments = [n for n, k in kinds.items() if k["kind"] in MOMENTS]
    if moments:  # deviations of the parts' means from the mean of all
        bucket = Window.partitionBy(*_named(*by)) if by else Window.partitionBy(F.lit(0))
        for name in moments:
            n, mean, m2 = (F.col(f"`{name}`.{f}") for f in ("n", "mean", "m2"))
            whole = F.sum(n * mean).over(bucket) / F.nullif(F.sum(n).over(bucket), F.lit(0))
            union = union.withColumn(name, F.struct(n.alias("n"), mean.alias("mean"), (m2 + n * (mean - whole) * (mean - whole)).alias("m2")))
    merged = [F.coalesce(F.sum(F.col(f"`{c}`")), F.lit(0)).cast("bigint").alias(c) for c in counts]
    for name, state in kinds.items():
        merged.append(_merged(name, state["kind"]).alias(name, metadata={STATE: state}))
    return union.groupBy(*_named(*by)).agg(*merged)


def _merged(name: str, kind: str) -> Column:
    at = lambda f: F.col(f"`{name}`.{f}")
    if kind in VALUES:
        value = F.coalesce(F.sum(at("value")), F.lit(0)) if kind == "count" else F.expr(f"{VALUES[kind]}(`{name}`.value)")
        return F.struct(value.alias("value"))
    if kind == "avg":
        return F.struct(F.sum(at("total")).alias("total"), F.coalesce(F.sum(at("n")), F.lit(0)).alias("n"))
    if kind in MOMENTS:
        n = F.coalesce(F.sum(at("n")), F.lit(0))
        return F.struct(n.alias("n"), (F.sum(at("n") * at("mean")) / F.nullif(n, F.lit(0))).alias("mean"), F.sum(at("m2")).alias("m2"))
    if kind == "approx_count_distinct":
        return F.struct(F.expr(f"hll_union_agg(`{name}`.sketch)").alias("sketch"))
    return F.struct(F.expr(f"kll_merge_agg_double(`{name}`.sketch)").alias("sketch"))


def finish_states(states: DataFrame) -> DataFrame:
    """The values that the state columns stand for; a bucket without parents has
    0 counts and null otherwise."""
    out = []
    for field in states.schema:
        state = (field.metadata or {}).get(STATE)
        if state is None:
            out.append(F.col(f"`{field.name}`"))
            continue
        kind, at = state["kind"], lambda f, name=field.name: F.col(f"`{name}`.{f}")
        if kind in VALUES:
            value = at("value")
        elif kind == "avg":
            value = at("total").cast("double") / F.nullif(at("n"), F.lit(0))
        elif kind in MOMENTS:
            value = at("m2") / F.nullif(at("n") - (1 if kind.endswith("samp") else 0), F.lit(0))
            value = F.sqrt(value) if kind.startswith("stddev") else value
        elif kind == "approx_count_distinct":
            value = F.coalesce(F.hll_sketch_estimate(at("sketch")), F.lit(0)).cast("bigint")
        else:
            held = F.kll_sketch_get_n_double(at("sketch"))
            value = F.when(held > 0, F.kll_sketch_get_quantile_double(at("sketch"), F.lit(float(state["fraction"]))))
        out.append(value.alias(field.name))
    return states.select(*out)


def parent_bitmaps(hits: DataFrame, relation: Relation, by: Sequence[str] | str = (), *, dedup: str = "map_side") -> DataFrame:
    """``(by…, id_block, bitmap)``: the ids of each bucket's parents, as bitmaps
    of 32,768 consecutive ids (4 KB each, for ids that lie close together; few
    and far ids are better kept as pairs). Parent keys must be integers. A bucket
    without parents keeps one row, with an empty bitmap."""
    by = _check_by(hits, by)
    if not isinstance(relation.key_type, T.IntegralType):
        raise TypeError("parent bitmaps need an integer parent key")
    lifted = lift_to_parents(hits, relation, by, keep_empty=True, dedup=dedup, parent_prefix="__kr_p_")
    key = F.col(f"`__kr_p_{relation.parent_key}`").cast("long")
    placed = lifted.select(*_named(*by), F.bitmap_bucket_number(key).alias("id_block"), F.bitmap_bit_position(key).alias("bit"))
    return placed.groupBy(*_named(*by), "id_block").agg(F.bitmap_construct_agg("bit").alias("bitmap"))


def merge_bitmaps(parts: Iterable[DataFrame], by: Sequence[str] | str = (), *, count_name: str = "doc_count",
                  repeated: str | None = None) -> DataFrame:
    """``(by…, doc_count)`` over the parents of all parts, each counted once
    however many parts hold it. ``repeated`` names a column with the number of
    parents that more than one part brought, counted once per further part."""
    parts = [p.withColumn(PARTS, F.bitmap_count("bitmap")) for p in parts]
    if not parts:
        raise ValueError("nothing to merge")
    by = [by] if isinstance(by, str) else list(by)
    union = reduce(DataFrame.unionByName, parts)
    blocks = union.groupBy(*_named(*by), "id_block").agg(F.bitmap_or_agg("bitmap").alias("bitmap"), F.sum(PARTS).alias(PARTS))
    counted = blocks.select(*_named(*by), F.bitmap_count("bitmap").alias("__kr_n"), PARTS)
    total = F.coalesce(F.sum("__kr_n"), F.lit(0)).cast("bigint")
    cols = [total.alias(count_name)]
    if repeated:
        cols.append((F.coalesce(F.sum(PARTS), F.lit(0)) - total).cast("bigint").alias(repeated))
    return counted.groupBy(*_named(*by)).agg(*cols)
