"""Child-to-parent roll-up.

``lift_to_parents`` turns matching child rows into their distinct parents,
once per bucket. ``parent_rollup`` counts those parents per bucket and runs
further aggregations over the parent rows (not over the children), keeping
buckets that have no parent at a count of 0.

Plan of ``parent_rollup`` with ``dedup="map_side"`` (the default; no
broadcast unless AQE measures the parent side small at run time):

1. project the hits to ``(bucket columns, parent key)``; the key is null for
   rows that are not in the child role or have no parent;
2. deduplicate the pairs, with Spark's partial aggregation inside each map
   task before the shuffle: a parent that holds a third of all children
   ships at most one row per bucket per task;
3. inner-join the pairs to the parent rows on the key (AQE may split a hot
   key on either side, also a parent id shared by a third of the parent
   rows), each parent row marked true;
4. union one bucket row per pair (marker null), read from the same pairs, so
   the exchange is reused and the hits are read once;
5. group by the buckets: ``count(marker)`` is the parent count, every
   sub-aggregation gets ``FILTER (WHERE marker)``; a bucket without parents
   keeps its row with 0 and empty (SQL NULL) sub-results.

When every sub-aggregation splits over parent keys (``count``, ``sum``,
``min``, ``max`` given as ``(function, expression)``, or none at all), steps
3-5 become: aggregate the parent rows per key (a group of copies collapses
map-side, in the exchange the join needs anyway), left-join the pairs to that
unique-per-key side, group by the buckets. No union, no second read.

``dedup="co_locate"`` hash-partitions the raw pairs by parent key, then
deduplicates and left-joins in the same stage: one exchange fewer, but a hot
key lands whole in one task; use it for keys known to be evenly spread.
``dedup="prepartitioned"`` is the same plan without the repartition, for
hits and parents stored bucketed by the key: no exchange before the join.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import replace
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinroll.plans.relation import Relation, _has_column
from kinroll.plans.strategy import check_dedup
from kinroll.session import cut_lineage

KEY = "__kr_key"
PKEY = "__kr_parent_key"
MARK = "__kr_parent"
CHILDREN = "__kr_children"
BUCKET_ROW = "__kr_bucket_row"
_BY = "__kr_by_"


def _check_by(hits: DataFrame, by, allow_stream: bool = False) -> list[str]:
    if not allow_stream and isinstance(hits, DataFrame) and hits.isStreaming:
        raise ValueError("hits are a stream: use kinroll.streaming.stream_parent_rollup")
    if by is None:
        return []
    if isinstance(by, str):
        by = [by]
    by = list(by)
    for b in by:
        if not isinstance(b, str):
            raise TypeError("bucket columns must be given by name")
        if b not in hits.columns and not _has_column(hits, b):
            raise ValueError(f"bucket column {b!r} is not in the hits")
    if len(set(by)) != len(by):
        raise ValueError("bucket columns repeat")
    return by


def _bucket(hits: DataFrame, name: str) -> Column:
    """A bucket column: by its literal name (``a.b`` may be one), else by path."""
    return F.col(f"`{name}`") if name in hits.columns else F.col(name)


def _check_outputs(names: Sequence[str], by: Sequence[str]) -> None:
    """Output names must differ from each other and from the buckets, in any
    letter case: a result with ``b`` and ``B`` could not be read by name."""
    taken = [n.lower() for n in (*by, *names)]
    if len(set(taken)) != len(taken):
        raise ValueError(f"output names repeat or clash with bucket columns: {list(names)}")


def _private(by: Sequence[str]) -> list[str]:
    return [f"{_BY}{i}" for i in range(len(by))]


def bucket_pairs(
    hits: DataFrame,
    relation: Relation,
    by: Sequence[str] = (),
    *,
    keep_empty: bool = True,
    dedup: str = "map_side",
    with_child_count: bool = False,
) -> DataFrame:
    """Distinct ``(bucket…, parent key)`` pairs of the hits, private names.

    With ``keep_empty`` a bucket whose hits hold no child still gives one
    ``(bucket, null)`` pair, so it survives the join. With
    ``with_child_count`` each pair carries the number of hits behind it.
    """
    check_dedup(dedup)
    relation.check_hits(hits)
    by = _check_by(hits, by)
    cols = [_bucket(hits, b).alias(p) for b, p in zip(by, _private(by))]
    pairs = hits.select(*cols, relation.child_key.alias(KEY))
    if not keep_empty:
        pairs = pairs.filter(F.col(KEY).isNotNull())
    return _dedup(pairs, _private(by), dedup, with_child_count)


def _dedup(pairs: DataFrame, priv: Sequence[str], dedup: str, with_child_count: bool = False) -> DataFrame:
    if dedup == "split":
        raise ValueError('dedup="split" is a plan of parent_rollup')
    if dedup == "co_locate":
        pairs = pairs.repartition(F.col(KEY))
    if with_child_count:
        return pairs.groupBy(*priv, KEY).agg(F.count(F.lit(1)).alias(CHILDREN))
    return pairs.distinct()


def _parent_side(relation: Relation, marker: bool, prefix: str = "") -> DataFrame:
    p = relation.parents.filter(F.col(relation.parent_key).isNotNull())
    cols = [F.col(relation.parent_key).alias(PKEY)]
    cols += [F.col(f"`{c}`").alias(f"{prefix}{c}") for c in p.columns]
    if marker:
        cols.append(F.lit(True).alias(MARK))
    return p.select(*cols)


def _join_parents(pairs: DataFrame, parents: DataFrame) -> DataFrame:
    """Inner equi-join of the pairs to their parent rows on the key.

    The comparison is null-safe on purpose: parents have no null key, so the
    result is the same, but Catalyst then infers no ``key IS NOT NULL`` filter
    to push under the pair deduplication. The pairs feeding the join and the
    pairs feeding the bucket rows stay one identical plan, whose exchange is
    reused: the hits are read and shuffled once.
    """
    return pairs.join(parents, pairs[KEY].eqNullSafe(parents[PKEY]), "inner").drop(KEY, PKEY)


def _restore_by(df: DataFrame, by: Sequence[str]) -> DataFrame:
    for b, p in zip(by, _private(by)):
        df = df.withColumnRenamed(p, b)
    return df


def _named(*names: str) -> list:
    """Columns by their literal names (a bucket may be called ``a.b``)."""
    return [F.col(f"`{n}`") for n in names]


def lift_to_parents(
    hits: DataFrame,
    relation: Relation,
    by: Sequence[str] | str = (),
    *,
    keep_empty: bool = False,
    dedup: str = "map_side",
    parent_prefix: str = "",
) -> DataFrame:
    """One row per (bucket, parent row) for every parent a matching child has.

    Output: the bucket columns followed by all parent columns (renamed with
    ``parent_prefix`` if given). A parent appears once per bucket however many
    of its children hit; a child whose parent is missing adds nothing.

    ``keep_empty`` is for chains: the buckets also get marker rows whose
    parent columns are all null (one per distinct child key, or per bucket),
    so a further ``parent_rollup`` reports buckets without parents at 0.
    """
    by = _check_by(hits, by)
    clash = set(by) & {f"{parent_prefix}{c}" for c in relation.parents.columns}
    if clash:
        raise ValueError(
            f"bucket columns clash with parent columns {sorted(clash)}; give a parent_prefix"
        )
    pairs = bucket_pairs(hits, relation, by, keep_empty=keep_empty, dedup=dedup)
    parents = _parent_side(relation, marker=False, prefix=parent_prefix)
    if dedup != "map_side":
        lifted = _co_located_rows(pairs, parents, keep_empty, False)
    else:
        lifted = _join_parents(pairs, parents)
        if keep_empty:
            # bucket markers from the same pairs plan (one scan of the hits)
            lifted = lifted.unionByName(pairs.drop(KEY), allowMissingColumns=True)
    return _restore_by(lifted, by)


# Aggregates that split over parent keys: per-key partials on the parent
# side, then the named combine over the bucket's keys.
SPLITTABLE = {"count": "sum", "sum": "sum", "min": "min", "max": "max"}


def _is_one_call(text: str) -> bool:
    """Whether ``text`` is a single function call: the bracket opened after the
    name closes at the very end. Quoted text is skipped."""
    m = re.fullmatch(r"\s*\w+\s*\((.*)\)\s*", text, re.DOTALL)
    if not m:
        return False
    depth = 0
    for part in re.finditer(r"'(?:[^'\\]|\\.)*'|\"[^\"]*\"|`[^`]*`|[()]", m.group(1)):
        depth += {"(": 1, ")": -1}.get(part.group(), 0)
        if depth < 0:
            return False
    return depth == 0


def _arguments(text: str) -> list[str]:
    """The comma-separated arguments of a call; brackets and quoted text are kept whole."""
    depth, parts = 0, [""]
    for piece in re.findall(r"'(?:[^'\\]|\\.)*'|\"[^\"]*\"|`[^`]*`|[()\[\],]|[^'\"`()\[\],]+|.", text, re.DOTALL):
        depth += {"(": 1, "[": 1, ")": -1, "]": -1}.get(piece, 0)
        if piece == "," and depth == 0:
            parts.append("")
        else:
            parts[-1] += piece
    return [p.strip() for p in parts]


def _filtered(relation: Relation, name: str, spec) -> bool:
    """Whether a sub-aggregation is one aggregate call, which takes a ``FILTER``;
    else it is an expression over aggregate calls. The parser decides, on the
    parent rows; what is neither is refused."""
    if not isinstance(spec, str):
        _as_sql(name, spec)
        return True
    if _is_one_call(spec):
        try:
            relation.parents.agg(F.expr(f"{spec} FILTER (WHERE true)"))
            return True
        except AnalysisException:
            pass
    try:
        relation.parents.agg(F.expr(spec))
        return False
    except AnalysisException as e:
        raise ValueError(f"sub-aggregation {name!r} must be a single aggregate call or an expression over such calls, "
                         f"got {spec!r}") from e


def _aggregate(rows: DataFrame, priv: Sequence[str], relation: Relation, aggs: Mapping, count_name: str,
               child_count: str | None, metadata: dict | None) -> DataFrame:
    """Count, child count and sub-aggregations per bucket of marked parent rows
    and unmarked bucket rows. Expressions over several calls cannot be filtered:
    for them the rows are grouped by the mark too, and the marked group's values
    taken per bucket (null where it has none)."""
    counts = [F.count(MARK).alias(count_name)]
    if child_count:
        counts.append(F.expr(f"sum({CHILDREN}) FILTER (WHERE {BUCKET_ROW})").alias(child_count))
    free = [n for n, spec in aggs.items() if not _filtered(relation, n, spec)]
    if not free:
        out = rows.groupBy(*priv).agg(*counts, *[_sub_agg(n, s) for n, s in aggs.items()])
    else:
        if not priv:  # the only bucket is there without rows too
            mark = rows.sparkSession.range(1).select(F.lit(None).cast("boolean").alias(MARK))
            rows = rows.unionByName(mark, allowMissingColumns=True)
        values = [F.expr(s).alias(n) if n in free else _sub_agg(n, s) for n, s in aggs.items()]
        halves = rows.groupBy(*priv, MARK).agg(*counts, *values)
        of = lambda n: F.first(F.when(F.col(MARK), F.struct(f"`{n}`")), ignorenulls=True)
        empty = lambda n: F.first(F.when(F.col(MARK).isNull(), F.struct(f"`{n}`")), ignorenulls=True)
        one = [(of(n) if n in free else F.coalesce(of(n), empty(n)))[n].alias(n) for n in aggs]
        summed = [F.sum(f"`{c}`").alias(c) for c in (count_name, *([child_count] if child_count else []))]
        out = halves.groupBy(*priv).agg(*summed, *one)
    return out.withMetadata(count_name, metadata) if metadata else out


def _as_sql(name: str, spec) -> str:
    """The aggregate call as SQL text. ``FILTER`` binds to the last call of a
    text, so an expression over several calls is refused: give each call its
    own name and combine them on the finished roll-up."""
    if isinstance(spec, str):
        if not _is_one_call(spec):
            raise ValueError(
                f"sub-aggregation {name!r} must be a single aggregate call, got {spec!r}; "
                "combine aggregates on the result of the roll-up"
            )
        return spec
    if isinstance(spec, tuple) and len(spec) == 2 and spec[0] in SPLITTABLE and isinstance(spec[1], str):
        if re.match(r"\s*distinct\b", spec[1], re.IGNORECASE):
            raise ValueError(f"sub-aggregation {name!r}: DISTINCT does not split over parents; give the call as a string")
        return f"{spec[0]}({spec[1]})"
    raise TypeError(
        f"sub-aggregation {name!r} must be a Spark SQL aggregate call (a string) or a pair "
        f"(function, SQL expression) with the function one of {sorted(SPLITTABLE)}"
    )


def _sub_agg(name: str, spec):
    return F.expr(f"{_as_sql(name, spec)} FILTER (WHERE {MARK})").alias(name)


def _splittable(aggs: Mapping) -> bool:
    return all(isinstance(v, tuple) for v in aggs.values())


AggSpec = str | tuple[str, str]

SAMPLE_SHARE = 0.02
LIVE_KEYS = 1_000_000


def heavy_keys(hits: DataFrame, relation: Relation, share: float | None = None, sample: float = SAMPLE_SHARE) -> list:
    """Parent keys (None for hits without one) that hold more than ``share`` of
    the hits, by a sample: a choice of plan, so an estimate will do. By default
    the share of one shuffle partition. At most ``1 / share`` keys are collected,
    from one pass over the key column."""
    relation.check_hits(hits)
    if share is None:
        share = 1 / max(2, int(hits.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    if not 0 < share < 1 or not 0 < sample <= 1:
        raise ValueError("share must be between 0 and 1, sample above 0 and at most 1")
    keys = hits.select(relation.child_key.alias(KEY))
    counts = (keys.sample(sample, seed=17) if sample < 1 else keys).groupBy(KEY).count()
    n = counts.agg(F.sum("count").alias("n")).first()["n"] or 0
    return [r[KEY] for r in counts.filter(F.col("count") > max(1, share * n)).collect()]


def only_live(hits: DataFrame, relation: Relation, max_keys: int = LIVE_KEYS) -> DataFrame:
    """The hits whose parent is among the relation's parents, as far as these
    can be told in the scan: where the (restricted) parents have ``max_keys`` keys
    at most, which is counted first, they go to every task and the hits are
    reduced before any shuffle; otherwise all hits stay, and the join decides as
    it would have. For results without empty buckets (``lift_to_parents``,
    ``parent_rollup(keep_empty=False)``), which it does not change."""
    relation.check_hits(hits)
    keys = relation.parents.select(F.col(relation.parent_key).alias(PKEY)).filter(F.col(PKEY).isNotNull()).distinct()
    if keys.limit(max_keys + 1).count() > max_keys:
        return hits
    held = hits.withColumn(KEY, relation.child_key)
    return held.join(F.broadcast(keys), held[KEY] == keys[PKEY], "left_semi").drop(KEY)


def _split_rollup(hits, relation, by, aggs, heavy, count_name, child_count, keep_empty, metadata) -> DataFrame:
    """Roll-ups of the light and the heavy keys' hits, disjoint by parent, merged."""
    values = [k for k in heavy if k is not None]
    key = relation.child_key
    is_heavy = F.coalesce(key.isin(values), F.lit(False)) if values else F.lit(False)
    if None in heavy:
        is_heavy = is_heavy | key.isNull()
    few = replace(relation, parents=relation.parents.filter(F.col(relation.parent_key).isin(values)))
    parts = [parent_rollup(part, rel, by, aggs, dedup=dedup, count_name=count_name, child_count=child_count)
             for part, rel, dedup in ((hits.filter(~is_heavy), relation, "co_locate"), (hits.filter(is_heavy), few, "map_side"))]
    merge = {n: SPLITTABLE[fn] for n, (fn, _) in aggs.items()} | ({child_count: "sum"} if child_count else {})
    types = dict((f.name, f.dataType) for f in parts[0].schema)
    merged = merge_rollups(parts, by, merge, count_name=count_name)
    merged = merged.withColumns({n: (F.coalesce(n, F.lit(0)) if aggs.get(n, ("",))[0] == "count" else F.col(f"`{n}`")).cast(types[n]) for n in merge})
    out = merged.select(*_named(*by, count_name, *([child_count] if child_count else []), *aggs))
    out = out if keep_empty else out.filter(F.col(count_name) > 0)
    return out.withMetadata(count_name, metadata) if metadata else out


def parent_rollup(
    hits: DataFrame,
    relation: Relation,
    by: Sequence[str] | str = (),
    aggs: Mapping[str, AggSpec] | None = None,
    *,
    keep_empty: bool = True,
    dedup: str = "map_side",
    heavy: Sequence | None = None,
    count_name: str = "doc_count",
    child_count: str | None = None,
    metadata: dict | None = None,
) -> DataFrame:
    """Parents per bucket: ``(by…, doc_count, child_count?, aggs…)``.

    ``aggs`` maps an output name to an aggregate over the bucket's parent
    rows (never over the children):

    * a pair ``(function, expression)`` with the function one of ``count``,
      ``sum``, ``min``, ``max``, e.g. ``{"total": ("sum", "o_totalprice")}``;
      these split over parent keys, so the parent rows are aggregated per
      key first (a group of copies of one parent id collapses map-side) and
      joined once, the cheapest skew-safe plan;
    * any Spark SQL aggregate as a string, e.g. ``"count(DISTINCT x)"``,
      ``"percentile_cont(0.5) WITHIN GROUP (ORDER BY x)"``, or an expression over
      aggregates, ``"round(sum(x) / count(*), 1)"``; evaluated over the joined
      parent rows. An expression is null for a bucket without parents, like any
      empty sub-result; single calls keep their own empty value (counts 0).

    Finish a result (cast, ratio, filter on ``doc_count``) with ordinary
    DataFrame code on the output.

    ``by=()`` gives one row, also for empty hits. ``keep_empty=False`` drops
    buckets that have no parent, the only bucket of ``by=()`` included. ``child_count`` adds the number of hits per
    bucket (the enclosing bucket's own count, children or not) from the same
    pass over the hits. ``metadata`` is attached to the ``doc_count`` column.

    ``dedup="split"`` takes the co-located plan for evenly spread keys and the
    map-side plan for ``heavy`` ones (``heavy_keys`` by default, one pass over a
    sample's keys; give them if they are known).
    """
    by = _check_by(hits, by)
    aggs = dict(aggs or {})
    names = [count_name, *aggs, *([child_count] if child_count else [])]
    _check_outputs(names, by)
    for n, spec in aggs.items():
        _filtered(relation, n, spec)
    if dedup == "split":
        if not _splittable(aggs):
            raise ValueError('dedup="split" takes sub-aggregations as pairs (function, expression)')
        heavy = heavy_keys(hits, relation) if heavy is None else list(heavy)
        if heavy:
            return _split_rollup(hits, relation, by, aggs, heavy, count_name, child_count, keep_empty, metadata)
        dedup = "co_locate"
    priv = _private(by)
    pairs = bucket_pairs(
        hits, relation, by, keep_empty=keep_empty or bool(child_count), dedup=dedup,
        with_child_count=child_count is not None,
    )
    if _splittable(aggs):
        out = _rollup_per_key(pairs, relation, priv, aggs, keep_empty, count_name, child_count, metadata, dedup == "map_side")
        return _restore_by(out, by).select(*_named(*by, count_name, *([child_count] if child_count else []), *aggs))
    parents = _parent_side(relation, marker=True)
    if dedup != "map_side":
        rows = _co_located_rows(pairs, parents, keep_empty, bool(child_count))
    else:
        rows = _join_parents(pairs, parents)
        if keep_empty or child_count:
            # One bucket row per pair: keeps buckets without parents (marker
            # null, so count and sub-aggregations skip it) and carries each
            # pair's hit count. Same pairs plan as the join side: one scan.
            buckets = pairs.withColumn(BUCKET_ROW, F.lit(True)).drop(KEY)
            rows = rows.unionByName(buckets, allowMissingColumns=True)
    out = _aggregate(rows, priv, relation, aggs, count_name, child_count, metadata)
    if not keep_empty:
        out = out.filter(F.col(count_name) > 0)
    return _restore_by(out, by).select(*_named(*by, count_name, *([child_count] if child_count else []), *aggs))


def _per_key_parents(relation: Relation, aggs: Mapping) -> DataFrame:
    """Parent rows aggregated per key: row count and per-key partials. Keys
    declared unique need no aggregation: a row is its key's partial. Should they
    repeat after all, the join repeats the pair and the combined result is still
    right; only a pair's hit count would be taken more than once."""
    if relation.unique_parents:
        one = [F.lit(1).cast("long").alias("__kr_n")]
        for i, (fn, expr) in enumerate(aggs.values()):
            held = "true" if expr.strip() == "*" else " AND ".join(f"({a}) IS NOT NULL" for a in _arguments(expr))
            counted = F.expr(f"if({held}, 1, 0)")
            one.append((counted.cast("long") if fn == "count" else F.expr(expr)).alias(f"__kr_p_{i}"))
        return relation.parents.filter(F.col(relation.parent_key).isNotNull()).select(
            F.col(relation.parent_key).alias(PKEY), *one)
    per_key = [F.count(F.lit(1)).alias("__kr_n")]
    per_key += [F.expr(f"{fn}({expr})").alias(f"__kr_p_{i}") for i, (fn, expr) in enumerate(aggs.values())]
    return (relation.parents.filter(F.col(relation.parent_key).isNotNull())
            .groupBy(F.col(relation.parent_key).alias(PKEY)).agg(*per_key))


def _per_key_outputs(relation: Relation, aggs: Mapping, count_name: str, metadata: dict | None) -> list:
    """Combine per-key partials over the bucket's keys (null partials: no
    parent), in the type the plain aggregate over the parent rows has."""
    plain = [F.expr(f"{fn}({expr})").alias(f"a{i}") for i, (fn, expr) in enumerate(aggs.values())]
    types = [f.dataType for f in relation.parents.agg(*plain).schema] if plain else []
    count_col = F.coalesce(F.sum("__kr_n"), F.lit(0)).cast("bigint")
    cols = [count_col.alias(count_name, metadata=metadata) if metadata else count_col.alias(count_name)]
    for i, (name, (fn, _)) in enumerate(aggs.items()):
        combined = F.expr(f"{SPLITTABLE[fn]}(__kr_p_{i})")
        if fn == "count":
            combined = F.coalesce(combined, F.lit(0))
        cols.append(combined.cast(types[i]).alias(name))
    return cols


def _rollup_per_key(pairs, relation, priv, aggs, keep_empty, count_name, child_count, metadata, splittable_join):
    """Roll-up when every sub-aggregation splits over parent keys.

    The parent rows are aggregated per key (row count and per-key partials,
    partial aggregation before the shuffle); that exchange by key is also the
    join's source, and the parent side is then unique per key. The pairs
    left-join it: buckets without parents stay (their partials are null) and
    each pair's hit count passes once. The keys are compared null-safely:
    parents have no null key, so the result is the same, but both sides then
    reach the join by a plain exchange and AQE may split a hot key, and the
    null key that all hits outside the child role share. Co-located plans
    keep the plain equality, which needs no exchange after theirs.
    """
    parents = _per_key_parents(relation, aggs)
    how = "left" if keep_empty or child_count else "inner"
    same = pairs[KEY].eqNullSafe(parents[PKEY]) if splittable_join else pairs[KEY] == parents[PKEY]
    rows = pairs.join(parents, same, how)
    out_cols = _per_key_outputs(relation, aggs, count_name, metadata)
    if child_count:
        out_cols.insert(1, F.sum(CHILDREN).alias(child_count))
    out = rows.groupBy(*priv).agg(*out_cols)
    if not keep_empty:
        out = out.filter(F.col(count_name) > 0)
    return out


def _co_located_rows(pairs: DataFrame, parents: DataFrame, keep_empty: bool, child_count: bool) -> DataFrame:
    """Pairs already partitioned by key: join without a further exchange.

    A left join keeps buckets without parents. With child counts, each pair
    goes in twice, as a join row and as a bucket row the join condition
    refuses, so the counts pass the join once per pair.
    """
    if not child_count:
        cond = pairs[KEY] == parents[PKEY]
        return pairs.join(parents, cond, "left" if keep_empty else "inner").drop(KEY, PKEY)
    kind = F.explode(F.array(F.lit(False), F.lit(True))).alias(BUCKET_ROW)
    p = pairs.select(*[c for c in pairs.columns], kind)
    p = p.withColumn(CHILDREN, F.when(F.col(BUCKET_ROW), F.col(CHILDREN)))
    cond = (p[KEY] == parents[PKEY]) & ~p[BUCKET_ROW]
    return p.join(parents, cond, "left").drop(KEY, PKEY)


def chain_rollup(
    hits: DataFrame,
    relations: Sequence[Relation],
    by: Sequence[str] | str = (),
    aggs: Mapping[str, AggSpec] | None = None,
    *,
    keep_empty: bool = True,
    dedup: str = "map_side",
    count_name: str = "doc_count",
    child_count: str | None = None,
    metadata: dict | None = None,
    checkpoint_every: int | None = None,
) -> DataFrame:
    """Grandchild → … → ancestor: lift through every relation but the last,
    deduplicating (bucket, key) at each level, then roll up over the last.

    With the default plan every level is an inner join of deduplicated pairs
    to that level's parents (the bucket columns travel under private names,
    so no parent column can clash with them), and the buckets of the hits
    join the final aggregation once, from the first level's pairs (reused
    exchange): buckets that reach no ancestor stay at 0. ``child_count`` adds the
    number of hits per bucket from those pairs, ``metadata`` goes on the count
    column, ``keep_empty=False`` drops buckets without an ancestor, all as in
    ``parent_rollup``.

    ``checkpoint_every=k`` writes the lifted rows after every k levels to the
    reliable checkpoint folder (``spark.checkpoint.dir``): a long chain then
    neither replans nor recomputes from the first level after a lost executor.
    Each checkpoint runs a job at call time.
    """
    relations = list(relations)
    if not relations:
        raise ValueError("at least one relation is needed")
    if checkpoint_every is not None and checkpoint_every < 1:
        raise ValueError("checkpoint_every must be positive")
    by = _check_by(hits, by)
    aggs = dict(aggs or {})
    names = [count_name, *aggs, *([child_count] if child_count else [])]
    _check_outputs(names, by)
    if dedup != "map_side":
        return _chain_by_levels(hits, relations, by, aggs, keep_empty, dedup, count_name, child_count, metadata, checkpoint_every)
    priv = _private(by)
    buckets_too = keep_empty or bool(child_count)
    first = bucket_pairs(hits, relations[0], by, keep_empty=buckets_too, with_child_count=child_count is not None)
    pairs = first.drop(CHILDREN) if child_count else first
    for i, rel in enumerate(relations[1:], start=1):
        lifted = _join_parents(pairs, _parent_side(relations[i - 1], marker=False))
        if checkpoint_every and i % checkpoint_every == 0:
            lifted = cut_lineage(lifted)
        rel.check_hits(lifted)
        step = lifted.select(*priv, rel.child_key.alias(KEY)).filter(F.col(KEY).isNotNull())
        pairs = _dedup(step, priv, dedup)
    last = relations[-1]
    if _splittable(aggs):
        # parents aggregated per key: unique per key, copies collapse map-side
        per_key = _per_key_parents(last, aggs)
        rows = pairs.join(per_key, pairs[KEY].eqNullSafe(per_key[PKEY]), "inner").drop(KEY, PKEY)
        agg_cols = _per_key_outputs(last, aggs, count_name, metadata)
    else:
        rows, agg_cols = _join_parents(pairs, _parent_side(last, marker=True)), None
    if buckets_too:
        rows = rows.unionByName(first.withColumn(BUCKET_ROW, F.lit(True)).drop(KEY),
                                allowMissingColumns=True)
    if agg_cols is None:
        out = _aggregate(rows, priv, last, aggs, count_name, child_count, metadata)
    else:
        if child_count:
            agg_cols.insert(1, F.expr(f"sum({CHILDREN}) FILTER (WHERE {BUCKET_ROW})").alias(child_count))
        out = rows.groupBy(*priv).agg(*agg_cols)
    if not keep_empty:
        out = out.filter(F.col(count_name) > 0)
    return _restore_by(out, by).select(*_named(*by, count_name, *([child_count] if child_count else []), *aggs))


def _chain_by_levels(hits, relations, by, aggs, keep_empty, dedup, count_name, child_count, metadata, checkpoint_every):
    """Chains under the co-located plans: lift level by level (left joins
    keep bucket markers), then roll up over the last relation. The buckets
    travel under names no parent column has."""
    carried = [f"__kr_level_{i}" for i in range(len(by))]
    level = hits.select("*", *[_bucket(hits, b).alias(c) for b, c in zip(by, carried)])
    for i, rel in enumerate(relations[:-1], start=1):
        level = lift_to_parents(level, rel, carried, keep_empty=keep_empty, dedup=dedup)
        if checkpoint_every and i % checkpoint_every == 0:
            level = cut_lineage(level)
    out = parent_rollup(level, relations[-1], carried, aggs, keep_empty=keep_empty, dedup=dedup,
                        count_name=count_name, metadata=metadata)
    if child_count:
        own = hits.groupBy(*[_bucket(hits, b).alias(f"__kr_own_{i}") for i, b in enumerate(by)]).agg(F.count(F.lit(1)).alias(child_count))
        same = [F.col(c).eqNullSafe(F.col(f"__kr_own_{i}")) for i, c in enumerate(carried)]
        out = out.join(own, same) if same else out.crossJoin(own)  # one row each without buckets
    return out.select(*[F.col(c).alias(b) for b, c in zip(by, carried)],
                      *_named(count_name, *([child_count] if child_count else []), *aggs))


# Aggregates of partial values that give the value of the whole.
COMBINING = ("sum", "min", "max", "bool_and", "bool_or", "bit_and", "bit_or", "bit_xor", "hll_union_agg", "bitmap_or_agg",
             "theta_union_agg", "kll_merge_agg_bigint", "kll_merge_agg_double", "kll_merge_agg_float")


def merge_rollups(
    parts: Iterable[DataFrame],
    by: Sequence[str] | str = (),
    merge: Mapping[str, str] | None = None,
    *,
    count_name: str = "doc_count",
) -> DataFrame:
    """Merge roll-ups computed separately (per shard, per run).

    Correct only when the parts are disjoint **by parent key** (families
    routed together, see ``kinroll.sources.family_shards``); otherwise a
    parent present in two parts is counted twice. ``merge`` maps each
    sub-aggregation column to the SQL aggregate that combines partial values
    (``sum`` for sums and counts, ``min``, ``max``, the bitwise and boolean ones,
    unions of sketches). Averages, percentiles and distinct counts do not combine
    and are refused: merge their states (``partial_rollup``). The metadata of the
    parts' count column (the last part's value of a key) goes on the merged
    one; without any row, ``by=()`` gives a count of 0.
    """
    parts = list(parts)
    if not parts:
        raise ValueError("nothing to merge")
    by = [by] if isinstance(by, str) else list(by)
    merge = dict(merge or {})
    for column, fn in merge.items():
        if fn.lower() not in COMBINING:
            raise ValueError(f"{fn!r} does not combine partial results of {column!r}; merge states instead (partial_rollup)")
    union = reduce(lambda a, b: a.unionByName(b), parts)
    metadata: dict = {}
    for part in parts:
        metadata.update(part.schema[count_name].metadata or {})
    total = F.coalesce(F.sum(count_name), F.lit(0)).cast("bigint")
    cols = [total.alias(count_name, metadata=metadata) if metadata else total.alias(count_name)]
    cols += [F.expr(f"{fn}(`{c}`)").alias(c) for c, fn in merge.items()]
    return union.groupBy(*by).agg(*cols)
