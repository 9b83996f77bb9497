"""Family operators: values gathered over a parent and its children, and
filters that look at a row's whole family.

A *family* is a parent row plus the child rows that point to it, in any child
role the mixed table declares for that parent; its key is the parent's id. The per-row visit of every family member is expressed as set
operations: one aggregation over all families, one semi-join back, so the
cost is linear in the rows, not in rows × family size.

Values come out in long form, one row per (family, distinct value) with its
multiplicity, never as one array per family: a family that holds a third of
all rows would otherwise become a single unbounded value.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinroll.plans.relation import Relation, _has_column

FAMILY = "__kr_family"


def _members(
    members: DataFrame,
    relation: Relation,
    value: str | None,
    keep: Column | None,
    parent_keep: Column | None,
    parent_value: str | None = None,
) -> DataFrame:
    """(family key, value or keep flag) of every family member: the children
    among ``members`` and the relation's parent rows."""
    relation.check_hits(members)
    child = relation.child_key if relation.member_key is None else relation.member_key
    kids = members.filter(child.isNotNull())
    cols = [child.alias(FAMILY)]
    if value is not None:
        cols.append(F.col(value).alias("__kr_value"))
    if keep is not None:
        cols.append(keep.alias("__kr_keep"))
    rows = kids.select(*cols)
    if not relation.mapped:
        return rows
    parents = relation.parents
    pcols = [F.col(relation.parent_key).alias(FAMILY)]
    if value is not None:
        if parent_value is None:
            return rows  # the parent rows do not hold the value
        pcols.append(F.col(parent_value).alias("__kr_value"))
    if keep is not None:
        if parent_keep is None:
            return rows  # parents are not tested
        pcols.append(parent_keep.alias("__kr_keep"))
    return rows.unionByName(parents.select(*pcols))


def family_values(
    members: DataFrame,
    relation: Relation,
    value: str,
    *,
    key_name: str | None = None,
    count_name: str = "n",
    parent_value: str | None = None,
) -> DataFrame:
    """``(family key, value, n)``: each distinct non-null ``value`` in a family,
    with the number of family rows holding it, the parent row included.
    ``parent_value`` names the parent rows' column; in the join-field layout it
    is ``value`` itself, between separate tables the parents hold no value
    unless it is given.

    ``members`` are the rows to visit: the child table in the typed layout,
    the whole mixed table in the join-field layout. Partial aggregation runs
    before the shuffle, so a huge family is combined map-side.
    """
    if not _has_column(members, value):
        raise ValueError(f"value column {value!r} is not in the rows")
    key_name = key_name or relation.parent_key
    out_value = value.split(".")[-1]
    if parent_value is None and relation.family_key is not None:
        parent_value = value
    if parent_value is not None and not _has_column(relation.parents, parent_value):
        raise ValueError(f"value column {parent_value!r} is not in the parent rows")
    rows = _members(members, relation, value, None, None, parent_value)
    return (
        rows.filter(F.col("__kr_value").isNotNull())
        .groupBy(FAMILY, "__kr_value")
        .agg(F.count(F.lit(1)).alias(count_name))
        .select(F.col(FAMILY).alias(key_name), F.col("__kr_value").alias(out_value), count_name)
    )


def _check_predicate(df: DataFrame, predicate) -> Column:
    if predicate is None:
        return F.lit(True)
    if not isinstance(predicate, Column):
        raise TypeError("predicate must be a boolean Column")
    dtype = df.select(predicate.alias("p")).schema.fields[0].dataType
    if not isinstance(dtype, T.BooleanType):
        raise TypeError(f"predicate must be boolean, got {dtype.simpleString()}")
    return predicate


def filter_rows(df: DataFrame, predicate: Column | None = None) -> DataFrame:
    """Keep the rows whose boolean ``predicate`` holds; no predicate keeps all."""
    return df.filter(_check_predicate(df, predicate))


def family_filter(
    docs: DataFrame,
    relation: Relation,
    members: DataFrame,
    condition: Column,
    *,
    docs_key: str | Column | None = None,
    parent_condition: Column | None = None,
) -> DataFrame:
    """Keep the rows of ``docs`` whose family has a member meeting ``condition``.

    ``members`` are the rows visited (children table or mixed table).
    Parent rows are visited with ``parent_condition``; in the join-field
    layout parents share the mixed table's columns, so ``condition`` is the
    default there. ``docs_key`` is the family key on ``docs`` (default: the
    relation's parent key, i.e. ``docs`` are parents). Each kept row appears
    once: a semi-join on the distinct matching family keys, compared null-safely
    (no matching key is null), so that both sides reach it by a plain exchange
    and AQE may split a large family.
    """
    condition = _check_predicate(members, condition)
    if parent_condition is None and relation.family_key is not None:
        parent_condition = condition
    if parent_condition is not None:
        parent_condition = _check_predicate(relation.parents, parent_condition)
    rows = _members(members, relation, None, condition, parent_condition)
    keys = rows.filter(F.col("__kr_keep") & F.col(FAMILY).isNotNull()).select(FAMILY).distinct()
    key = docs_key if docs_key is not None else relation.parent_key
    key = F.col(key) if isinstance(key, str) else key
    return docs.join(keys, key.eqNullSafe(keys[FAMILY]), "left_semi")


def family_counts(
    members: DataFrame,
    relation: Relation,
    counts: Mapping[str, Column],
    *,
    size: str = "size",
    key_name: str | None = None,
    with_parents: bool | None = None,
) -> DataFrame:
    """``(family key, size, <name>…)``: a family's members, and how many of them
    meet each named condition (a null condition is not met).

    ``with_parents`` counts the parent rows as members too, under the same
    conditions; by default where members and parents share a mixed table. One
    aggregation by family, partial before its shuffle: a family that holds a
    third of all rows ships one row per task.
    """
    if not counts:
        raise ValueError("at least one named condition is needed")
    if size in counts:
        raise ValueError(f"condition name {size!r} is the name of the family's size")
    if with_parents is None:
        with_parents = relation.family_key is not None
    relation.check_hits(members)
    child = relation.child_key if relation.member_key is None else relation.member_key
    marks = [F.coalesce(_check_predicate(members, c), F.lit(False)).cast("int").alias(f"__kr_c{i}")
             for i, c in enumerate(counts.values())]
    rows = members.select(child.alias(FAMILY), *marks)
    if with_parents and relation.mapped:
        rows = rows.unionByName(relation.parents.select(F.col(relation.parent_key).alias(FAMILY), *marks))
    summed = [F.sum(f"__kr_c{i}").alias(n) for i, n in enumerate(counts)]
    families = rows.filter(F.col(FAMILY).isNotNull()).groupBy(FAMILY).agg(F.count(F.lit(1)).alias(size), *summed)
    return families.withColumnRenamed(FAMILY, key_name or relation.parent_key)


def family_having(
    docs: DataFrame,
    relation: Relation,
    members: DataFrame,
    counts: Mapping[str, Column],
    having: str,
    *,
    size: str = "size",
    docs_key: str | Column | None = None,
    with_parents: bool | None = None,
) -> DataFrame:
    """Keep the rows of ``docs`` whose family, as a whole, meets ``having``.

    ``counts`` names conditions on single members; ``having`` is a boolean SQL
    expression over how many members meet each, and the family's ``size``:
    ``"closed = size AND size >= 3"`` (all, and at least three), ``"late = 0"``
    (none), ``"a > 0 AND b > 0"`` (some member of each kind). A row whose family
    has no member, or that has no family key, is judged with all counts 0. The
    families are aggregated first and left-joined (null-safely, so that AQE may
    split a large family among ``docs``).
    """
    families = family_counts(members, relation, counts, size=size, key_name=FAMILY, with_parents=with_parents)
    names = [size, *counts]
    private = families.select(FAMILY, *[F.col(n).alias(f"__kr_n{i}") for i, n in enumerate(names)])
    key = docs_key if docs_key is not None else relation.parent_key
    key = F.col(key) if isinstance(key, str) else key
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__kr_row")
    held = docs.select(row, key.alias("__kr_docs_key"))
    joined = held.join(private, held["__kr_docs_key"].eqNullSafe(private[FAMILY]), "left").select(
        "__kr_row", *[F.coalesce(f"__kr_n{i}", F.lit(0)).alias(n) for i, n in enumerate(names)])
    kept = joined.filter(_check_predicate(joined, F.expr(having)))
    return kept.select("__kr_row.*")
