"""Inputs: the parquet tables, the reference's test documents, a mixed
parent/child table built from two tables, and family routing.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``<sf_dir>/<name>.parquet``. Column pruning and filters reach the scan."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


JOIN_FIELD = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("parent", T.StringType()),
])

CASES_SCHEMA = T.StructType([
    T.StructField("_id", T.StringType(), False),
    T.StructField("join_field", JOIN_FIELD),
    T.StructField("type", T.StringType()),
    T.StructField("action", T.StringType()),
    T.StructField("actionId", T.LongType()),
])

# The documents of the reference's only test, one index holding
# cases (parents) and activities (children); relation case -> activity.
# (id, role, parent id, type, action, actionId)
CASES_ROWS = [
    ("case1", "case", None, "case", "actionA", 1),
    ("case2", "case", None, "case", "actionB", 2),
    ("activity1", "activity", "case1", "activity", "actionA", 3),
    ("activity2", "activity", "case1", "activity", "actionB", 4),
    ("activity3", "activity", "case1", "activity", "actionC", 5),
    ("activity4", "activity", "case1", "activity", "actionC", 5),
    ("activity5", "activity", "case2", "activity", "actionB", 4),
    ("activity6", "activity", "case2", "activity", "actionC", 5),
    ("activity7", "activity", "case2", "activity", "actionD", 6),
]
CASES_RELATIONS = {"case": "activity"}


def cases_fixture(spark: SparkSession) -> DataFrame:
    """The reference test's nine documents as one mixed table."""
    rows = [(i, (role, parent), typ, action, aid) for i, role, parent, typ, action, aid in CASES_ROWS]
    return spark.createDataFrame(rows, CASES_SCHEMA)


def join_field_rows(
    df: DataFrame,
    role: str,
    *,
    id_of: str | Column | None = None,
    parent_of: str | Column | None = None,
    key_type: T.DataType | None = None,
    id_column: str = "_id",
    join_column: str = "join_field",
) -> DataFrame:
    """Rows of ``df`` in the join-field layout: ``_id`` from ``id_of`` (null if
    not given), ``join_field = (role, parent_of)``, other columns kept.

    ``key_type`` (default: the type of ``id_of`` or ``parent_of``) is the one
    type ids and parent ids share across the mixed table.
    """
    def col(c):
        return None if c is None else (F.col(c) if isinstance(c, str) else c)

    idc, parc = col(id_of), col(parent_of)
    if key_type is None:
        probe = idc if idc is not None else parc
        if probe is None:
            raise ValueError("give id_of, parent_of or key_type")
        key_type = df.select(probe.alias("k")).schema.fields[0].dataType
    idc = F.lit(None).cast(key_type) if idc is None else idc.cast(key_type)
    parc = F.lit(None).cast(key_type) if parc is None else parc.cast(key_type)
    return df.select(
        idc.alias(id_column),
        F.struct(F.lit(role).alias("name"), parc.alias("parent")).alias(join_column),
        *[F.col(f"`{c}`") for c in df.columns],
    )


def mixed_table(
    parents: DataFrame,
    children: DataFrame,
    *,
    parent_id: str,
    child_parent_id: str,
    parent_role: str,
    child_role: str,
    child_id: str | Column | None = None,
    id_column: str = "_id",
    join_column: str = "join_field",
) -> DataFrame:
    """Both tables in one, in the join-field layout.

    Parent rows get ``_id = parent_id`` and ``join_field = (parent_role, null)``;
    child rows get ``join_field = (child_role, child_parent_id)`` and an id from
    ``child_id`` (null if not given). Other columns are kept, missing ones are
    null. Key types follow the parent id (no cast to string).
    """
    key_type = parents.schema[parent_id].dataType
    p = join_field_rows(parents, parent_role, id_of=parent_id, key_type=key_type,
                        id_column=id_column, join_column=join_column)
    c = join_field_rows(children, child_role, id_of=child_id, parent_of=child_parent_id,
                        key_type=key_type, id_column=id_column, join_column=join_column)
    return p.unionByName(c, allowMissingColumns=True)


def family_route(key: str | Column, shards: int) -> Column:
    """Shard number of a row routed by its family key (as documents are routed
    by parent id so a family never spans two shards)."""
    if shards < 1:
        raise ValueError("shards must be positive")
    k = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.xxhash64(k), F.lit(shards))


def family_shards(df: DataFrame, key: str | Column, shards: int) -> list[DataFrame]:
    """Split ``df`` into ``shards`` parts routed by family key.

    The parts cover every row exactly once (a null key hashes to one fixed
    shard), so roll-ups of the parts can be merged with ``merge_rollups``.
    """
    route = family_route(key, shards)
    return [df.filter(route == F.lit(i)) for i in range(shards)]


def write_co_located(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None) -> None:
    """Write ``df`` bucketed and sorted by ``key`` (families co-located on
    disk), so later joins and roll-ups on ``key`` need no shuffle."""
    w = df.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)
