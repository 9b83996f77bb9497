"""The physical plans: pushdown, pruning, exchanges, no slow paths."""

import pytest
from pyspark.sql import functions as F

from kinroll import Relation, parent_rollup
from kinroll.plans import plan_shape, pushed_filters, scan_columns
from tools.plan_inspect import executed_shape
from kinroll.registry import QUERIES
from kinroll.sources import read_table

from .conftest import SF01


def test_filter_and_columns_reach_the_scan(spark):
    li = read_table(spark, SF01, "lineitem").filter(F.col("l_quantity") > 25)
    rel = Relation.from_tables(read_table(spark, SF01, "orders"), child_key="l_orderkey",
                               parent_key="o_orderkey")
    r = parent_rollup(li, rel, "l_returnflag", {"sp": "sum(o_totalprice)"})
    assert any("l_quantity" in f for f in pushed_filters(r))
    cols = scan_columns(r)
    assert sorted(["l_orderkey", "l_quantity", "l_returnflag"]) in [sorted(c) for c in cols]
    assert sorted(["o_orderkey", "o_totalprice"]) in [sorted(c) for c in cols]


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.adaptive.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, old)


def _rel(spark):
    return Relation.from_tables(read_table(spark, SF01, "orders"), child_key="l_orderkey",
                                parent_key="o_orderkey")


def test_map_side_plan_reads_hits_once(spark, no_broadcast):
    li = read_table(spark, SF01, "lineitem")
    r = parent_rollup(li, _rel(spark), "l_returnflag", {"n": "max_by(o_custkey, o_totalprice)"},
                      child_count="c")
    shape = executed_shape(r)
    # pairs by (bucket, key), pairs by key, parents by key, buckets; the
    # bucket-row branch reuses the pairs exchange, so lineitem is scanned once
    assert shape["hash_exchanges"] == 4
    assert shape["reused_exchanges"] == 1
    assert shape["file_scans"] == 2
    assert shape["broadcast_joins"] == 0


def test_per_key_plan_has_one_branch(spark, no_broadcast):
    li = read_table(spark, SF01, "lineitem")
    r = parent_rollup(li, _rel(spark), "l_returnflag", {"s": ("sum", "o_totalprice")}, child_count="c")
    shape = executed_shape(r)
    # pairs by (bucket, key), pairs by key, parents aggregated by key (the
    # join's exchange too), buckets; nothing read twice
    assert shape["hash_exchanges"] == 5  # the null-safe join re-deals the unique parents, so AQE can split it
    assert shape["reused_exchanges"] == 0
    assert shape["file_scans"] == 2
    assert shape["sort_merge_joins"] == 1


def test_co_locate_plan_skips_an_exchange(spark, no_broadcast):
    li = read_table(spark, SF01, "lineitem")
    shape = executed_shape(parent_rollup(li, _rel(spark), "l_returnflag", dedup="co_locate"))
    assert shape["hash_exchanges"] == 3
    assert shape["file_scans"] == 2


def test_static_plan_has_no_broadcast(spark):
    li = read_table(spark, SF01, "lineitem")
    assert plan_shape(parent_rollup(li, _rel(spark), "l_returnflag"))["broadcast_joins"] == 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_no_python(spark, name):
    shape = plan_shape(QUERIES[name](spark, SF01))
    assert shape["cartesian"] == 0
    assert shape["python_udfs"] == 0
    # Only a roll-up without buckets gathers into one partition, and only the
    # one partial row per task of its final aggregate.
    assert shape["single_partition_exchanges"] == {"rollup_global": 1, "rollup_lookup": 1}.get(name, 0)  # global counts


def test_chain_reads_hits_once(spark, no_broadcast):
    from kinroll import chain_rollup

    li = read_table(spark, SF01, "lineitem").filter(F.col("l_quantity") > 45)
    rels = [_rel(spark), Relation.from_tables(read_table(spark, SF01, "customer"),
                                              child_key="o_custkey", parent_key="c_custkey")]
    shape = executed_shape(chain_rollup(li, rels, "l_returnflag"))
    assert shape["file_scans"] == 3  # lineitem once, orders, customer
    assert shape["reused_exchanges"] == 1


def test_chain_co_locate_agrees(spark):
    from kinroll import chain_rollup

    li = read_table(spark, SF01, "lineitem").filter(F.col("l_quantity") > 45)
    rels = [_rel(spark), Relation.from_tables(read_table(spark, SF01, "customer"),
                                              child_key="o_custkey", parent_key="c_custkey")]
    a = chain_rollup(li, rels, "l_returnflag", {"s": "sum(c_acctbal)"}).collect()
    b = chain_rollup(li, rels, "l_returnflag", {"s": "sum(c_acctbal)"}, dedup="co_locate").collect()
    norm = lambda rows: sorted((r[0], r[1], round(r[2], 4)) for r in rows)
    assert norm(a) == norm(b)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_wide_tables_are_pruned(spark, name):
    """No registered query reads every column of a table with five or more."""
    import re

    from kinroll.plans.strategy import physical_plan

    plan = physical_plan(QUERIES[name](spark, SF01))
    if name == "rollup_running":  # reads its roll-up's written result: see rollup_orders_by_part for the scans
        assert "ExistingRDD" in plan and "FileScan" not in plan
        return
    scans = list(re.finditer(
        r"FileScan parquet .*?Location: [^\[]*\[file:([^\]]+)\].*?ReadSchema: struct<(.*)>", plan))
    assert scans, "no file scan found in the plan"
    for m in scans:
        table = m.group(1).rsplit("/", 1)[-1].removesuffix(".parquet")
        read = len(re.split(r",(?![^<]*>)", m.group(2)))
        if name == "rollup_stored":  # reads the two-column tables it wrote, not the given ones
            assert read == 2
            continue
        total = len(read_table(spark, SF01, table).columns)
        if total >= 5:
            assert read < total, (table, read, total)


def test_texts_are_not_shuffled(spark):
    """Text analysis runs in the scan's tasks where there are enough of them."""
    from kinroll.plans import spread

    docs = read_table(spark, SF01, "documents").select("doc_id", "text")
    few = spread(docs, "doc_id")
    assert plan_shape(few)["hash_exchanges"] == 1
    wide = docs.unionByName(docs)
    while wide.rdd.getNumPartitions() < spark.sparkContext.defaultParallelism:
        wide = wide.unionByName(docs)
    assert plan_shape(spread(wide, "doc_id"))["hash_exchanges"] == 0


def test_lookup_has_one_rollup(spark, no_broadcast):
    shape = executed_shape(QUERIES["rollup_lookup"](spark, SF01))
    assert shape["sort_merge_joins"] == 1
    assert shape["file_scans"] == 3  # orders and customer of the roll-up, orders of the hit total
