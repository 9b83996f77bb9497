"""Hot keys: a third of the children on one parent, a third of the parent
rows copies of one id. Results stay exact and AQE may split the join."""

import pytest
from pyspark.sql import functions as F

from kinroll import Relation, family_filter, parent_rollup
from kinroll.plans.strategy import physical_plan
from kinroll.sources import read_table

from .conftest import SF01

HOT = 7  # an order key present in the table


@pytest.fixture
def skew_conf(spark):
    conf = {
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    }
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _expected(hits, parents):
    pairs = hits.select("l_returnflag", "l_orderkey").distinct()
    j = pairs.join(parents, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return {r[0]: (r[1], r[2]) for r in j.groupBy("l_returnflag").agg(
        F.count("o_orderkey"), F.sum("o_custkey")).collect()}


def _got(df):
    return {r["l_returnflag"]: (r["doc_count"], r["sc"]) for r in df.collect()}


def test_hot_child_key(spark, skew_conf):
    li = read_table(spark, SF01, "lineitem")
    hot = li.withColumn("l_orderkey", F.when(F.col("l_linenumber") <= 3, F.lit(HOT).cast("bigint"))
                        .otherwise(F.col("l_orderkey")))
    orders = read_table(spark, SF01, "orders")
    rel = Relation.from_tables(orders, child_key="l_orderkey", parent_key="o_orderkey")
    share = hot.filter(F.col("l_orderkey") == HOT).count() / hot.count()
    assert share > 0.3
    for dedup in ("map_side", "co_locate"):
        r = parent_rollup(hot, rel, "l_returnflag", {"sc": "sum(o_custkey)"}, dedup=dedup)
        assert _got(r) == _expected(hot, orders)


def test_hot_parent_copies_split_by_aqe(spark, skew_conf):
    """40,000 parent rows share one id (their payload differs). The parent
    side comes from several map tasks, as any large table does; AQE then
    splits that key's partition, which the inner join allows."""
    li = read_table(spark, SF01, "lineitem")
    orders = read_table(spark, SF01, "orders")
    copies = (orders.filter(F.col("o_orderkey") == HOT)
              .withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(40000))))
              .withColumn("o_custkey", F.col("copy").cast("bigint")).drop("copy"))
    parents = orders.unionByName(copies).repartition(8)
    assert parents.filter(F.col("o_orderkey") == HOT).count() / parents.count() > 0.3
    rel = Relation.from_tables(parents, child_key="l_orderkey", parent_key="o_orderkey")
    r = parent_rollup(li, rel, "l_returnflag", {"sc": "sum(o_custkey)"})
    assert _got(r) == _expected(li, parents)
    plan = physical_plan(r).split("== Initial Plan ==")[0]
    assert "SortMergeJoin(skew=true)" in plan


def test_hot_parent_copies_collapse_per_key(spark, skew_conf):
    """With splittable sub-aggregations the parent rows are aggregated per key
    before the join: 40,000 copies of one id become one row map-side."""
    li = read_table(spark, SF01, "lineitem")
    orders = read_table(spark, SF01, "orders")
    copies = (orders.filter(F.col("o_orderkey") == HOT)
              .withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(40000))))
              .withColumn("o_custkey", F.col("copy").cast("bigint")).drop("copy"))
    parents = orders.unionByName(copies).repartition(8)
    rel = Relation.from_tables(parents, child_key="l_orderkey", parent_key="o_orderkey")
    r = parent_rollup(li, rel, "l_returnflag", {"sc": ("sum", "o_custkey")})
    assert _got(r) == _expected(li, parents)


def test_hot_child_key_with_many_buckets(spark, skew_conf):
    """One parent behind a third of the lines, bucketed by a nearly unique
    value: after dedup that parent still has ~26k pairs. Both plans' joins
    read both sides straight from shuffle stages, so AQE splits the crowded
    pairs partition."""
    li = read_table(spark, SF01, "lineitem")
    hot = li.withColumn("l_orderkey", F.when(F.col("l_linenumber") <= 3, F.lit(HOT).cast("bigint"))
                        .otherwise(F.col("l_orderkey")))
    orders = read_table(spark, SF01, "orders")
    rel = Relation.from_tables(orders, child_key="l_orderkey", parent_key="o_orderkey")
    pairs = hot.select("l_extendedprice", "l_orderkey").distinct()
    j = pairs.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    want = {x[0]: (x[1], x[2]) for x in j.groupBy("l_extendedprice").agg(
        F.count("o_orderkey"), F.sum("o_custkey")).collect()}
    for agg in ("sum(o_custkey)", ("sum", "o_custkey")):
        r = parent_rollup(hot, rel, "l_extendedprice", {"sc": agg})
        got = {x["l_extendedprice"]: (x["doc_count"], x["sc"]) for x in r.collect()}
        assert got == want
        assert "SortMergeJoin(skew=true)" in physical_plan(r).split("== Initial Plan ==")[0]


def test_third_of_null_keys_split(spark, skew_conf):
    """Hits without a parent key share the null key: AQE splits it as well."""
    li = read_table(spark, SF01, "lineitem").repartition(8)
    hits = li.withColumn("l_orderkey", F.when(F.col("l_linenumber") > 3, F.col("l_orderkey")))
    assert hits.filter("l_orderkey is null").count() / hits.count() > 0.3
    orders = read_table(spark, SF01, "orders")
    rel = Relation.from_tables(orders, child_key="l_orderkey", parent_key="o_orderkey")
    r = parent_rollup(hits, rel, "l_extendedprice", {"sc": ("sum", "o_custkey")})
    pairs = hits.select("l_extendedprice", "l_orderkey").distinct()
    j = pairs.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    want = {x[0]: (x[1], x[2]) for x in j.groupBy("l_extendedprice").agg(
        F.count("o_orderkey"), F.sum("o_custkey")).collect()}
    assert {x["l_extendedprice"]: (x["doc_count"], x["sc"]) for x in r.collect()} == want
    assert "SortMergeJoin(skew=true)" in physical_plan(r).split("== Initial Plan ==")[0]


def test_hot_family_split(spark, skew_conf):
    """A family that holds a third of the documents does not stay in one task."""
    li = read_table(spark, SF01, "lineitem").repartition(8)
    hot = li.withColumn("l_orderkey", F.when(F.col("l_linenumber") <= 3, F.lit(HOT).cast("bigint"))
                        .otherwise(F.col("l_orderkey")))
    rel = Relation.from_tables(read_table(spark, SF01, "orders"), child_key="l_orderkey", parent_key="o_orderkey")
    kept = family_filter(hot, rel, li, F.col("l_quantity") > 40, docs_key="l_orderkey")
    rows = kept.collect()
    keys = {r[0] for r in li.filter("l_quantity > 40").select("l_orderkey").distinct().collect()}
    assert len(rows) == sum(r[0] in keys for r in hot.select("l_orderkey").collect())
    assert "SortMergeJoin(skew=true)" in physical_plan(kept).split("== Initial Plan ==")[0]
