"""Family co-location on disk: hits and parents bucketed by the family key
need no exchange before the join."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from kinroll import Relation, parent_rollup
from tools.plan_inspect import executed_shape
from kinroll.sources import read_table, write_co_located

from .conftest import SF01


@pytest.fixture(scope="module")
def bucketed(spark):
    folder = tempfile.mkdtemp(prefix="kinroll-buckets-")
    write_co_located(read_table(spark, SF01, "lineitem"), "kr_lineitem_b", "l_orderkey", 8,
                     path=os.path.join(folder, "lineitem"))
    write_co_located(read_table(spark, SF01, "orders"), "kr_orders_b", "o_orderkey", 8,
                     path=os.path.join(folder, "orders"))
    return spark.table("kr_lineitem_b"), spark.table("kr_orders_b")


def test_prepartitioned_rollup_skips_exchanges(spark, bucketed):
    lines, orders = bucketed
    key = "spark.sql.adaptive.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        rel = Relation.from_tables(orders, child_key="l_orderkey", parent_key="o_orderkey")
        hits = lines.filter(F.col("l_quantity") > 25)
        r = parent_rollup(hits, rel, "l_returnflag", {"sp": "sum(o_totalprice)"},
                          dedup="prepartitioned", child_count="n")
        shape = executed_shape(r)
        assert shape["hash_exchanges"] == 1  # only the final one, by bucket
        plain = read_table(spark, SF01, "lineitem").filter(F.col("l_quantity") > 25)
        prel = Relation.from_tables(read_table(spark, SF01, "orders"), child_key="l_orderkey",
                                    parent_key="o_orderkey")
        want = parent_rollup(plain, prel, "l_returnflag", {"sp": "sum(o_totalprice)"}, child_count="n")
        norm = lambda df: sorted((x[0], x[1], x[2], round(x[3], 4)) for x in df.collect())
        assert norm(r) == norm(want)
    finally:
        spark.conf.set(key, old)


def test_prepartitioned_still_right_on_plain_input(spark):
    lines = read_table(spark, SF01, "lineitem").filter(F.col("l_quantity") > 49)
    rel = Relation.from_tables(read_table(spark, SF01, "orders").filter(F.col("o_orderstatus") != "P"),
                               child_key="l_orderkey", parent_key="o_orderkey")
    a = parent_rollup(lines, rel, "l_partkey", dedup="prepartitioned").collect()
    b = parent_rollup(lines, rel, "l_partkey").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
