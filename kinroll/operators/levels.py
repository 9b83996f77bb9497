"""Results at every level of a chain, and buckets within buckets.

``chain_levels`` reports what ``chain_rollup`` reports for its last level at
**every** level, from one pass over the hits. The pairs (bucket, key) that climb
to the next level carry the sums of the levels below: a level is one left join
of the deduplicated pairs to its parents and one aggregation by (bucket, next
key), which deduplicates the next level's pairs and adds the sums up at once.

``bucket_levels`` and ``bucket_tree`` group the lifted parents by columns of
theirs, at all depths from one lift.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinroll.operators.rollup import (
    CHILDREN,
    KEY,
    PKEY,
    SPLITTABLE,
    _arguments,
    _as_sql,
    _bucket,
    _check_by,
    _named,
    _private,
    _restore_by,
    lift_to_parents,
)
from kinroll.plans.relation import Relation, _has_column

NEXT = "__kr_next"
CARRY = "__kr_carry"

Level = tuple


def _check_levels(levels: Sequence[Level], by: Sequence[str], child_count: str | None) -> list[tuple[str, Relation, dict]]:
    checked, names = [], [*by, *([child_count] if child_count else [])]
    for level in levels:
        name, relation, aggs = (*level, {}) if len(level) == 2 else level
        for n, spec in aggs.items():
            _as_sql(n, spec)
            if not isinstance(spec, tuple):
                raise TypeError(f"sub-aggregation {n!r}: levels take pairs (function, expression)")
        names += [name, *aggs]
        checked.append((name, relation, dict(aggs)))
    if not checked:
        raise ValueError("at least one level is needed")
    if len(set(names)) != len(names):
        raise ValueError(f"output names repeat or clash with bucket columns: {names}")
    return checked


def _level_parents(relation: Relation, up: Relation | None, aggs: Mapping, prefix: str) -> DataFrame:
    """Parents per (key, next key): their number and partial results."""
    if up is not None:
        up.check_hits(relation.parents)
    keys = [F.col(relation.parent_key).alias(PKEY), *([up.child_key.alias(NEXT)] if up is not None else [])]
    rows = relation.parents.filter(F.col(relation.parent_key).isNotNull())
    cols = [F.count(F.lit(1)).alias(f"{prefix}n")]
    cols += [F.expr(f"{fn}({expr})").alias(f"{prefix}{i}") for i, (fn, expr) in enumerate(aggs.values())]
    return rows.groupBy(*keys).agg(*cols)


def chain_levels(hits: DataFrame, levels: Sequence[Level], by: Sequence[str] | str = (), *,
                 child_count: str | None = None) -> DataFrame:
    """One row per bucket: ``(by…, child_count?, <name>, <aggs>…, <name>, …)``.

    ``levels`` are ``(name, relation)`` or ``(name, relation, aggs)``, lowest
    first: the parents of one are the children of the next. ``name`` becomes the
    level's count of distinct parents per bucket, ``aggs`` (pairs of function and
    expression, as in ``parent_rollup``) run over these parents. A bucket that
    ends below a level has 0 there and null sub-results; no bucket is dropped.

    Repeated parent ids: every row counts, and climbs under its own next key; the
    sums that a pair carries from below then pass the join on a row of their own,
    so that repeats do not multiply them.
    """
    by = _check_by(hits, by)
    levels = _check_levels(levels, by, child_count)
    priv = _private(by)
    levels[0][1].check_hits(hits)
    pairs = hits.select(*[_bucket(hits, b).alias(p) for b, p in zip(by, priv, strict=True)], levels[0][1].child_key.alias(KEY))
    pairs = pairs.groupBy(*priv, KEY).agg(F.count(F.lit(1)).alias(CHILDREN))
    sums = {CHILDREN: "sum"}
    for depth, (_, relation, aggs) in enumerate(levels):
        up = levels[depth + 1][1] if depth + 1 < len(levels) else None
        prefix = f"__kr_l{depth}_"
        parents = _level_parents(relation, up, aggs, prefix)
        if not relation.unique_parents:
            pairs = pairs.select(*priv, KEY, *sums, F.explode(F.array(F.lit(False), F.lit(True))).alias(CARRY)).select(
                *priv, F.when(~F.col(CARRY), F.col(KEY)).alias(KEY), *[F.when(F.col(CARRY), F.col(c)).alias(c) for c in sums])
        joined = pairs.join(parents, pairs[KEY].eqNullSafe(parents[PKEY]), "left")
        sums[f"{prefix}n"] = "sum"
        sums |= {f"{prefix}{i}": SPLITTABLE[fn] for i, (fn, _) in enumerate(aggs.values())}
        keys = [F.col(NEXT).alias(KEY)] if up is not None else []
        pairs = joined.groupBy(*priv, *keys).agg(*[F.expr(f"{fn}({c})").alias(c) for c, fn in sums.items()])
    out = [F.coalesce(CHILDREN, F.lit(0)).cast("bigint").alias(child_count)] if child_count else []
    for depth, (name, relation, aggs) in enumerate(levels):
        prefix = f"__kr_l{depth}_"
        out.append(F.coalesce(f"{prefix}n", F.lit(0)).cast("bigint").alias(name))
        plain = [F.expr(f"{fn}({expr})").alias(f"a{i}") for i, (fn, expr) in enumerate(aggs.values())]
        types = [f.dataType for f in relation.parents.agg(*plain).schema] if plain else []
        for i, (agg, (fn, _)) in enumerate(aggs.items()):
            value = F.col(f"{prefix}{i}")
            out.append((F.coalesce(value, F.lit(0)) if fn == "count" else value).cast(types[i]).alias(agg))
    return _restore_by(pairs.select(*priv, *out), by)


def bucket_levels(hits: DataFrame, relation: Relation, by: Sequence[str] | str, below: Sequence[str] | str,
                  aggs: Mapping[str, str | tuple] | None = None, *, count_name: str = "doc_count",
                  level: str = "level", dedup: str = "map_side") -> DataFrame:
    """Parents per bucket, per (bucket, first column of ``below``), and so on to
    all of them: ``(level, by…, below…, doc_count, aggs…)`` in long form. ``level``
    is the number of ``below`` columns that hold, the others are null.

    One lift, then grouping sets over the lifted parents, so that any aggregate
    may be asked for (a distinct count of a bucket is not the sum of those of the
    buckets below). Buckets without parents keep their row at level 0, with 0: they
    come from a second read of the hits' bucket columns, so hits drawn at random or by
    a limit should be written first.

    Distinct counts of one expression beside counts, sums, minima and maxima are not
    expanded per level: see ``_distinct_levels``.
    """
    by, below = _check_by(hits, by), [below] if isinstance(below, str) else list(below)
    for c in below:
        if not _has_column(relation.parents, c):
            raise ValueError(f"column {c!r} is not in the parent rows")
    aggs = dict(aggs or {})
    names = [level, *by, *below, count_name, *aggs]
    if not below or len(set(names)) != len(names):
        raise ValueError(f"output names repeat or clash, or nothing is below: {names}")
    marked = replace(relation, parents=relation.parents.withColumn("__kr_one", F.lit(1)))
    lifted = lift_to_parents(hits, marked, by, dedup=dedup, parent_prefix="__kr_p_")
    renamed = [F.col(f"`__kr_p_{c}`").alias(c) for c in relation.parents.columns]
    rows = lifted.select(*[F.col(f"`{b}`").alias(p) for b, p in zip(by, _private(by), strict=True)],
                         *renamed, F.col("__kr_p___kr_one").alias("__kr_one"))
    # the buckets, combined in the scan's tasks: not from the pairs, which a few tasks would hold
    buckets = hits.select(*[_bucket(hits, b).alias(p) for b, p in zip(by, _private(by), strict=True)])
    rows = rows.unionByName(buckets.distinct(), allowMissingColumns=True)
    inner = [f"__kr_b{i}" for i in range(len(below))]
    rows = rows.withColumns({i: F.col(f"`{c}`") for i, c in zip(inner, below, strict=True)})
    outer = _private(by)
    sets = [[F.col(c) for c in (*outer, *inner[:k])] for k in range(len(below) + 1)]
    depth = (F.lit(len(below)) - _absent(inner)).cast("int").alias("__kr_level")
    calls = _distinct_calls(aggs)
    if calls:
        grouped = _distinct_levels(rows, outer, inner, sets, depth, calls)
    else:
        cols = [F.expr(f"{_as_sql(n, s)} FILTER (WHERE __kr_one = 1)").alias(f"__kr_a{i}") for i, (n, s) in enumerate(aggs.items())]
        grouped = rows.groupingSets(sets, *outer, *inner).agg(F.count("__kr_one").alias("__kr_count"), depth, *cols)
    found = grouped.filter((F.col("__kr_level") == 0) | (F.col("__kr_count") > 0))
    return found.select(F.col("__kr_level").alias(level), *[F.col(p).alias(b) for b, p in zip(by, outer, strict=True)],
                        *[F.col(i).alias(c) for i, c in zip(inner, below, strict=True)], F.col("__kr_count").alias(count_name),
                        *[F.col(f"__kr_a{i}").alias(n) for i, n in enumerate(aggs)])


def _distinct_calls(aggs: Mapping) -> list[tuple[str, str, bool]] | None:
    """The aggregates as ``(function, expression, distinct)`` where they are distinct
    counts of one expression and calls that split; else None."""
    calls = []
    for name, spec in aggs.items():
        text = _as_sql(name, spec)
        m = re.fullmatch(rf"\s*({'|'.join(SPLITTABLE)})\s*\(\s*(distinct\b)?(.*)\)\s*", text, re.DOTALL | re.IGNORECASE)
        if not m or len(_arguments(m[3])) != 1 or (m[2] and m[1].lower() != "count"):
            return None
        calls.append((m[1].lower(), "1" if m[3].strip() == "*" else m[3].strip(), bool(m[2])))
    return calls if len({expr for _, expr, distinct in calls if distinct}) == 1 else None


def _distinct_levels(rows: DataFrame, outer: list, inner: list, sets: list, depth: Column, calls: list) -> DataFrame:
    """Grouping sets with distinct counts, without a set of values per level: the
    rows are grouped by all columns and the counted value once; the first row of a
    value in each bucket of each level is marked, and the levels add up the marks.
    Rows without a value have none to mark and keep their own place in the shuffle.
    """
    value = next(expr for _, expr, distinct in calls if distinct)
    split = [(i, fn, expr) for i, (fn, expr, distinct) in enumerate(calls) if not distinct]
    types = {f.name: f.dataType for f in rows.agg(
        F.lit(0), *[F.expr(f"{fn}({expr})").alias(f"__kr_a{i}") for i, fn, expr in split]).schema}
    valued = rows.withColumn("__kr_value", F.when(F.col("__kr_one") == 1, F.expr(value)))
    firsts = valued.groupBy(*outer, *inner, "__kr_value").agg(
        F.count("__kr_one").alias("__kr_n"),
        *[F.expr(f"{fn}({expr}) FILTER (WHERE __kr_one = 1)").alias(f"__kr_a{i}") for i, fn, expr in split])
    none = F.col("__kr_value").isNull()
    firsts = firsts.withColumn("__kr_place", F.when(none, F.xxhash64(*inner)))
    for k in range(len(inner)):
        within = Window.partitionBy(*outer, "__kr_value", "__kr_place", *inner[:k]).orderBy(*inner[k:])
        firsts = firsts.withColumn(f"__kr_first{k}", F.row_number().over(within))
    marks = [F.sum(F.when(~none & (F.col(f"__kr_first{k}") == 1), 1)).alias(f"__kr_marks{k}") for k in range(len(inner))]
    marks.append(F.count("__kr_value").alias(f"__kr_marks{len(inner)}"))
    sums = [F.expr(f"{SPLITTABLE[fn]}(__kr_a{i})").alias(f"__kr_a{i}") for i, fn, _ in split]
    grouped = firsts.groupingSets(sets, *outer, *inner).agg(F.sum("__kr_n").alias("__kr_count"), depth, *marks, *sums)
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    held = zero(F.element_at(F.array(*[F.col(f"__kr_marks{k}") for k in range(len(inner) + 1)]), F.col("__kr_level") + 1))
    out = [(held if distinct else zero(F.col(f"__kr_a{i}")) if fn == "count" else F.col(f"__kr_a{i}").cast(types[f"__kr_a{i}"])).alias(f"__kr_a{i}")
           for i, (fn, _, distinct) in enumerate(calls)]
    return grouped.select(*outer, *inner, zero(F.col("__kr_count")).alias("__kr_count"), "__kr_level", *out)


def _absent(columns: Sequence[str]):
    return reduce(lambda a, b: a + b, [F.grouping(c).cast("int") for c in columns])


def bucket_tree(hits: DataFrame, relation: Relation, by: Sequence[str] | str, below: str,
                aggs: Mapping[str, str | tuple] | None = None, *, count_name: str = "doc_count",
                children: str = "buckets", dedup: str = "map_side") -> DataFrame:
    """The nested view of two levels: ``(by…, doc_count, aggs…, buckets)`` with
    ``buckets`` an array of ``struct<below, doc_count, aggs…>`` in the order of
    ``below`` (null first), empty where a bucket has no parent. An array holds one
    entry per sub-bucket of its bucket, never rows; where a column has very many
    values, read ``bucket_levels`` instead."""
    by, aggs = _check_by(hits, by), dict(aggs or {})
    rows = bucket_levels(hits, relation, by, below, aggs, count_name=count_name, level="__kr_depth", dedup=dedup)
    top = F.col("__kr_depth") == 0
    values = [count_name, *aggs]
    entry = F.struct(F.col(f"`{below}`").alias(below), *_named(*values))
    cols = [F.first(F.when(top, F.struct(*_named(*values))), ignorenulls=True).alias("__kr_top"),  # the only one
            F.sort_array(F.collect_list(F.when(~top, entry))).alias(children)]
    private = _private(by)
    nested = rows.groupBy(*[F.col(f"`{b}`").alias(p) for b, p in zip(by, private, strict=True)]).agg(*cols)
    return nested.select(*[F.col(p).alias(b) for b, p in zip(by, private, strict=True)],
                         *[F.col(f"__kr_top.`{v}`").alias(v) for v in values], F.col(children))
