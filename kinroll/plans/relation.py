"""A parent/child relation: which rows are children, which are parents, and
the key that ties them.

Two layouts are supported, as in the source of the semantics:

* **typed tables** – children and parents are separate DataFrames; the child
  holds a foreign key, the parent a primary key (``Relation.from_tables``);
* **join field** – one mixed table whose ``join_field`` struct names each
  row's role and, for a child, its parent's id (``Relation.from_join_field``).

A relation whose child role is unknown is *unmapped*: every bucket gets a
parent count of 0 and empty sub-results, and no error is raised.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _has_column(df: DataFrame, name: str) -> bool:
    """Whether ``name`` (``a`` or ``a.b`` into structs) is in the schema."""
    dtype: T.DataType = df.schema
    for part in name.strip("`").split("."):
        if not isinstance(dtype, T.StructType):
            return False
        match = [f for f in dtype.fields if f.name == part]
        if not match:
            return False
        dtype = match[0].dataType
    return True


def _column_type(df: DataFrame, name: str) -> T.DataType:
    return df.select(name).schema.fields[0].dataType


def _check_name(value, what: str) -> str:
    if value is None:
        raise ValueError(f"{what} must not be None")
    if not isinstance(value, str):
        raise TypeError(f"{what} must be a string, got {type(value).__name__}")
    if not value:
        raise ValueError(f"{what} must not be empty")
    return value


@dataclass(frozen=True, eq=False)
class Relation:
    """Resolved relation. Build it with one of the two constructors.

    ``parents`` are the live parent rows (delete or restrict them before
    building the relation). ``child_key`` is evaluated on hit rows and yields
    the parent key for a row in the child role, null for any other row.
    """

    parents: DataFrame
    parent_key: str
    child_key: Column = field(repr=False)
    child_role: str | None = None
    parent_role: str | None = None
    mapped: bool = True
    key_type: T.DataType | None = field(default=None, repr=False)
    required_hit_columns: tuple[str, ...] = ()
    # Join-field layout only: the family key of any row of the mixed table
    # (own id for a parent, parent id for a child, null otherwise).
    family_key: Column | None = field(default=None, repr=False)
    # The same for children only: the parent id of a row in any child role of
    # the parent role, not just ``child_role``.
    member_key: Column | None = field(default=None, repr=False)
    # The caller's word that no parent key repeats (not checked): roll-ups then
    # skip the aggregation of the parents per key.
    unique_parents: bool = False

    # Two relations are equal when they name the same roles and keys; the
    # DataFrames themselves are not compared.
    def _identity(self):
        return (self.parent_key, self.child_role, self.parent_role, self.mapped,
                self.required_hit_columns)

    def __eq__(self, other):
        return isinstance(other, Relation) and self._identity() == other._identity()

    def __hash__(self):
        return hash(self._identity())

    # ------------------------------------------------------------------ build

    @classmethod
    def from_tables(
        cls,
        parents: DataFrame,
        *,
        child_key: str,
        parent_key: str,
        child_role: str | None = None,
        role_column: str | None = None,
        unique_parents: bool = False,
    ) -> "Relation":
        """Children and parents in separate tables.

        Every hit row with a non-null ``child_key`` is a child. With
        ``role_column`` and ``child_role``, only hit rows whose role equals
        ``child_role`` are children (one table holding several child types).
        ``unique_parents`` declares that no parent key repeats (a primary key),
        which saves roll-ups one aggregation. It is not checked: with repeated
        keys a ``child_count`` comes out too high.
        """
        _check_name(child_key, "child_key")
        _check_name(parent_key, "parent_key")
        if not isinstance(parents, DataFrame):
            raise TypeError("parents must be a DataFrame")
        if not _has_column(parents, parent_key):
            raise ValueError(f"parent key column {parent_key!r} is not in the parent table")
        if (role_column is None) != (child_role is None):
            raise ValueError("role_column and child_role go together")
        key = F.col(child_key)
        required = (child_key,)
        if role_column is not None:
            _check_name(role_column, "role_column")
            _check_name(child_role, "child_role")
            key = F.when(F.col(role_column) == F.lit(child_role), F.col(child_key))
            required = (child_key, role_column)
        return cls(
            parents=parents,
            parent_key=parent_key,
            child_key=key,
            child_role=child_role,
            mapped=True,
            key_type=_column_type(parents, parent_key),
            required_hit_columns=required,
            unique_parents=unique_parents,
        )

    @classmethod
    def from_join_field(
        cls,
        docs: DataFrame,
        *,
        child_role: str,
        relations: Mapping[str, str | Iterable[str]],
        id_column: str = "_id",
        join_column: str = "join_field",
        unique_parents: bool = False,
    ) -> "Relation":
        """One mixed table with a ``struct<name, parent>`` join column.

        ``relations`` maps a parent role to its child role(s), as declared in
        the table's schema. Parents are the rows of ``docs`` in the parent
        role, keyed by their own id; children are hit rows in ``child_role``,
        keyed by ``join_column.parent``. A ``child_role`` not declared in
        ``relations`` gives an unmapped relation. ``unique_parents`` as in
        ``from_tables``.
        """
        _check_name(child_role, "child_role")
        _check_name(id_column, "id_column")
        _check_name(join_column, "join_column")
        if not isinstance(docs, DataFrame):
            raise TypeError("docs must be a DataFrame")
        if not isinstance(relations, Mapping):
            raise TypeError("relations must map a parent role to its child role(s)")
        for c in (id_column, f"{join_column}.name", f"{join_column}.parent"):
            if not _has_column(docs, c):
                raise ValueError(f"column {c!r} is not in the table")

        parent_role, siblings = None, []
        for p_role, c_roles in relations.items():
            roles = [c_roles] if isinstance(c_roles, str) else list(c_roles)
            if child_role in roles:
                parent_role, siblings = p_role, roles
                break

        role = F.col(f"{join_column}.name")
        key_type = _column_type(docs, id_column)
        required = (join_column,)
        if parent_role is None:
            # Unmapped: no parent can match, the plan keeps only the buckets.
            # The empty parent side is pruned by the optimizer.
            return cls(
                parents=docs.filter(F.lit(False)),
                parent_key=id_column,
                child_key=F.lit(None).cast(key_type),
                child_role=child_role,
                parent_role=None,
                mapped=False,
                key_type=key_type,
                required_hit_columns=(),
            )
        parents = docs.filter(role == F.lit(parent_role))
        child_key = F.when(role == F.lit(child_role), F.col(f"{join_column}.parent"))
        if _column_type(docs, f"{join_column}.parent") != key_type:
            raise TypeError(
                f"{join_column}.parent and {id_column} have different types; cast one first"
            )
        member_key = F.when(role.isin(siblings), F.col(f"{join_column}.parent"))
        family_key = member_key.when(role == F.lit(parent_role), F.col(id_column))
        return cls(
            parents=parents,
            parent_key=id_column,
            child_key=child_key,
            child_role=child_role,
            parent_role=parent_role,
            mapped=True,
            key_type=key_type,
            required_hit_columns=required,
            unique_parents=unique_parents,
            family_key=family_key,
            member_key=member_key,
        )

    # ------------------------------------------------------------- helpers

    def check_hits(self, hits: DataFrame) -> None:
        """Raise if ``hits`` lack the key column or hold it with another type."""
        if not isinstance(hits, DataFrame):
            raise TypeError("hits must be a DataFrame")
        for c in self.required_hit_columns:
            if not _has_column(hits, c):
                raise ValueError(f"hits have no column {c!r} needed by the relation")
        if self.mapped and self.key_type is not None:
            got = hits.select(self.child_key.alias("k")).schema.fields[0].dataType
            if got != self.key_type:
                raise TypeError(
                    f"child key type {got.simpleString()} differs from parent key type "
                    f"{self.key_type.simpleString()}; cast one side first"
                )
