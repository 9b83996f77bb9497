"""Edge cases of FIXTURES.md §4, made by hand."""

import pytest
from pyspark.sql import functions as F

from kinroll import (
    Relation,
    bucket_counts,
    chain_rollup,
    lift_to_parents,
    parent_rollup,
    term_buckets,
)
from kinroll.sources import CASES_RELATIONS, read_table

from .conftest import SF01


def _rel(cases, role="activity"):
    return Relation.from_join_field(cases, child_role=role, relations=CASES_RELATIONS)


def _as_dict(df, key, val="doc_count"):
    return {r[key]: r[val] for r in df.collect()}


def test_missing_parent_bucket_drops_to_zero(spark):
    li = read_table(spark, SF01, "lineitem").filter(F.col("l_quantity") > 49)
    live = read_table(spark, SF01, "orders").filter(F.col("o_orderstatus") != "P")
    rel = Relation.from_tables(live, child_key="l_orderkey", parent_key="o_orderkey")
    r = parent_rollup(li, rel, "l_partkey")
    assert r.count() == 887
    assert r.filter(F.col("doc_count") == 0).count() == 248
    # keep_empty=False drops exactly those buckets
    assert parent_rollup(li, rel, "l_partkey", keep_empty=False).count() == 887 - 248


def test_negative_controls_differ(spark):
    """A child-row count and a plain count(distinct key) are not the roll-up."""
    li = read_table(spark, SF01, "lineitem").filter(F.col("l_quantity") > 49)
    live = read_table(spark, SF01, "orders").filter(F.col("o_orderstatus") != "P")
    rel = Relation.from_tables(live, child_key="l_orderkey", parent_key="o_orderkey")
    good = _as_dict(parent_rollup(li, rel, "l_partkey"), "l_partkey")
    distinct = _as_dict(li.groupBy("l_partkey").agg(F.countDistinct("l_orderkey").alias("doc_count")), "l_partkey")
    rows = _as_dict(bucket_counts(li, "l_partkey"), "l_partkey")
    assert good != distinct
    assert good != rows


def test_null_parent_key_keeps_bucket(spark, cases):
    extra = spark.createDataFrame(
        [("orphan", ("activity", None), "activity", "lonely", 9)], cases.schema)
    docs = cases.unionByName(extra)
    hits = term_buckets(docs.filter(F.col("type") == "activity"), "action", "term")
    got = _as_dict(parent_rollup(hits, _rel(docs), "term"), "term")
    assert got["lonely"] == 0
    assert got["actionc"] == 2


def test_parent_row_among_hits_counts_zero(cases):
    hits = term_buckets(cases.filter(F.col("_id") == "case1"), "action", "term")
    got = _as_dict(parent_rollup(hits, _rel(cases), "term"), "term")
    assert got == {"actiona": 0}


def test_empty_hits_without_buckets_gives_one_row(cases):
    hits = cases.filter(F.lit(False))
    rows = parent_rollup(hits, _rel(cases), (), {"s": "sum(actionId)"}).collect()
    assert len(rows) == 1
    assert rows[0]["doc_count"] == 0 and rows[0]["s"] is None


def test_empty_hits_with_buckets_gives_no_rows(cases):
    hits = cases.filter(F.lit(False))
    assert parent_rollup(hits, _rel(cases), "type").count() == 0


def test_unknown_child_role_is_zero_not_error(cases):
    hits = term_buckets(cases.filter(F.col("type") == "activity"), "action", "term")
    rel = _rel(cases, "shipment")
    assert not rel.mapped
    r = parent_rollup(hits, rel, "term", {"s": "sum(actionId)", "n": "count(*)"})
    got = {x["term"]: (x["doc_count"], x["s"], x["n"]) for x in r.collect()}
    assert got == {t: (0, None, 0) for t in ("actiona", "actionb", "actionc", "actiond")}
    assert lift_to_parents(hits, rel, "term").count() == 0


def test_bad_arguments(spark, cases):
    orders = read_table(spark, SF01, "orders")
    with pytest.raises(ValueError):
        Relation.from_tables(orders, child_key="l_orderkey", parent_key="no_such_column")
    with pytest.raises(ValueError):
        Relation.from_join_field(cases, child_role=None, relations=CASES_RELATIONS)
    with pytest.raises(TypeError):
        Relation.from_join_field(cases, child_role=5, relations=CASES_RELATIONS)
    with pytest.raises(ValueError):
        Relation.from_join_field(cases, child_role="activity", relations=CASES_RELATIONS,
                                 join_column="nope")
    rel = Relation.from_tables(orders, child_key="l_orderkey", parent_key="o_orderkey")
    with pytest.raises(ValueError):  # hits lack the key column
        parent_rollup(read_table(spark, SF01, "part"), rel, "p_brand")
    li = read_table(spark, SF01, "lineitem")
    with pytest.raises(ValueError):  # unknown bucket column
        parent_rollup(li, rel, "nope")
    with pytest.raises(TypeError):  # sub-aggregation not a SQL string
        parent_rollup(li, rel, "l_returnflag", {"s": F.sum("o_totalprice")})
    with pytest.raises(ValueError):  # output name clashes with a bucket
        parent_rollup(li, rel, "l_returnflag", {"l_returnflag": "count(*)"})
    with pytest.raises(ValueError):
        parent_rollup(li, rel, "l_returnflag", dedup="bogus")


def test_key_types_must_match(spark):
    nation = read_table(spark, SF01, "nation")  # n_nationkey: int
    orders = read_table(spark, SF01, "orders")  # o_custkey: bigint
    rel = Relation.from_tables(nation, child_key="o_custkey", parent_key="n_nationkey")
    with pytest.raises(TypeError):
        parent_rollup(orders, rel, "o_orderstatus")


def test_duplicate_parent_rows_each_count(spark):
    parents = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "pid long, tag string")
    kids = spark.createDataFrame([(1, "x"), (1, "x"), (2, "x"), (3, "y")], "fk long, b string")
    rel = Relation.from_tables(parents, child_key="fk", parent_key="pid")
    got = _as_dict(parent_rollup(kids, rel, "b"), "b")
    assert got == {"x": 3, "y": 0}


def test_child_in_several_buckets_and_repeated_term(spark):
    parents = spark.createDataFrame([(1,), (2,)], "pid long")
    kids = spark.createDataFrame([(1, "red blue"), (2, "red red"), (2, "Blue")], "fk long, txt string")
    rel = Relation.from_tables(parents, child_key="fk", parent_key="pid")
    hits = term_buckets(kids, "txt", "term")
    r = parent_rollup(hits, rel, "term", child_count="children")
    got = {x["term"]: (x["children"], x["doc_count"]) for x in r.collect()}
    assert got == {"red": (2, 2), "blue": (2, 2)}


def test_three_levels_dedup_each_level(spark):
    li = read_table(spark, SF01, "lineitem").filter(F.col("l_quantity") > 45)
    orders = read_table(spark, SF01, "orders")
    cust = read_table(spark, SF01, "customer")
    rels = [Relation.from_tables(orders, child_key="l_orderkey", parent_key="o_orderkey"),
            Relation.from_tables(cust, child_key="o_custkey", parent_key="c_custkey")]
    got = _as_dict(chain_rollup(li, rels, "l_returnflag"), "l_returnflag")
    expect = {r["l_returnflag"]: r["n"] for r in (
        li.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("l_returnflag").agg(F.countDistinct("o_custkey").alias("n")).collect())}
    assert got == expect


def test_null_bucket_value(spark):
    parents = spark.createDataFrame([(1,), (2,)], "pid long")
    kids = spark.createDataFrame([(1, None), (2, None), (2, "a b")], "fk long, txt string")
    rel = Relation.from_tables(parents, child_key="fk", parent_key="pid")
    got = _as_dict(parent_rollup(kids, rel, "txt"), "txt")
    assert got == {None: 2, "a b": 1}  # null is its own group in the roll-up
    got = _as_dict(parent_rollup(term_buckets(kids, "txt", "t"), rel, "t"), "t")
    assert got == {"a": 1, "b": 1}  # term buckets drop it


def test_metadata_carried_on_doc_count(cases):
    hits = cases.filter(F.col("type") == "activity")
    r = parent_rollup(hits, _rel(cases), "type", metadata={"agg": "cases"})
    assert r.schema["doc_count"].metadata == {"agg": "cases"}


def test_bucket_clash_needs_prefix(cases):
    hits = cases.filter(F.col("type") == "activity")
    with pytest.raises(ValueError):
        lift_to_parents(hits, _rel(cases), "action")
    lifted = lift_to_parents(hits, _rel(cases), "action", parent_prefix="parent_")
    got = {(r["action"], r["parent__id"]) for r in lifted.collect()}
    assert ("actionC", "case1") in got and ("actionC", "case2") in got
    assert len(got) == 7 - 1  # activity3/activity4 share (actionC, case1)


def test_typed_tables_with_role_column(spark):
    parents = spark.createDataFrame([(1,), (2,)], "pid long")
    rows = spark.createDataFrame([(1, "note", "a"), (2, "task", "a"), (2, "note", "b")],
                                 "fk long, kind string, b string")
    rel = Relation.from_tables(parents, child_key="fk", parent_key="pid",
                               child_role="note", role_column="kind")
    got = _as_dict(parent_rollup(rows, rel, "b"), "b")
    assert got == {"a": 1, "b": 1}


def test_relation_equality():
    from pyspark.sql import SparkSession
    s = SparkSession.getActiveSession()
    p = s.createDataFrame([(1,)], "pid long")
    a = Relation.from_tables(p, child_key="fk", parent_key="pid")
    b = Relation.from_tables(p.filter("pid > 0"), child_key="fk", parent_key="pid")
    c = Relation.from_tables(p, child_key="fk2", parent_key="pid")
    assert a == b and hash(a) == hash(b)
    assert a == a
    assert len({a, b}) == 1
    assert c.required_hit_columns != a.required_hit_columns


def test_chain_with_checkpoints_matches(spark):
    li = read_table(spark, SF01, "lineitem").filter(F.col("l_quantity") > 40)
    rels = [
        Relation.from_tables(read_table(spark, SF01, "orders"), child_key="l_orderkey", parent_key="o_orderkey"),
        Relation.from_tables(read_table(spark, SF01, "customer"), child_key="o_custkey", parent_key="c_custkey"),
        Relation.from_tables(read_table(spark, SF01, "nation"), child_key="c_nationkey", parent_key="n_nationkey"),
        Relation.from_tables(read_table(spark, SF01, "region"), child_key="n_regionkey", parent_key="r_regionkey"),
    ]
    a = chain_rollup(li, rels, "l_returnflag", {"r": "max(r_name)"}).collect()
    b = chain_rollup(li, rels, "l_returnflag", {"r": "max(r_name)"}, checkpoint_every=1).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    with pytest.raises(ValueError):
        chain_rollup(li, rels, "l_returnflag", checkpoint_every=0)


def test_cluster_conf_bounds():
    from kinroll.session import cluster_conf

    big = cluster_conf(100 * 2**40, 8000)
    assert 24_000 <= int(big["spark.sql.shuffle.partitions"]) < 200_000  # 102,401: no ceiling binds
    small = cluster_conf(2**30, 64)
    assert int(small["spark.sql.shuffle.partitions"]) == 192
    with pytest.raises(ValueError):
        cluster_conf(0, 8)


def test_split_aggregates_match_sql_aggregates(spark):
    """(function, expression) pairs and SQL strings give the same roll-up,
    also with duplicate parent ids, empty buckets and child counts."""
    parents = spark.createDataFrame([(1, 5), (1, 7), (2, None), (4, 1)], "pid long, v long")
    kids = spark.createDataFrame([(1, "x"), (1, "x"), (2, "x"), (3, "y"), (None, "z"), (4, "y")],
                                 "fk long, b string")
    rel = Relation.from_tables(parents, child_key="fk", parent_key="pid")
    pairs = {"n": ("count", "v"), "rows": ("count", "*"), "s": ("sum", "v"),
             "lo": ("min", "v"), "hi": ("max", "v")}
    sql = {"n": "count(v)", "rows": "count(*)", "s": "sum(v)", "lo": "min(v)", "hi": "max(v)"}
    for kw in ({}, {"child_count": "c"}, {"keep_empty": False}, {"keep_empty": False, "child_count": "c"}):
        a = sorted(map(tuple, parent_rollup(kids, rel, "b", pairs, **kw).collect()), key=str)
        b = sorted(map(tuple, parent_rollup(kids, rel, "b", sql, **kw).collect()), key=str)
        assert a == b, kw
    got = {r["b"]: (r["doc_count"], r["rows"], r["s"]) for r in parent_rollup(kids, rel, "b", pairs).collect()}
    assert got == {"x": (3, 3, 12), "y": (1, 1, 1), "z": (0, 0, None)}
    empty = parent_rollup(kids.filter(F.lit(False)), rel, (), pairs).collect()
    assert [tuple(r) for r in empty] == [(0, 0, 0, None, None, None)]
    with pytest.raises(TypeError):
        parent_rollup(kids, rel, "b", {"m": ("median", "v")})


def test_parent_role_with_two_child_roles(spark):
    rows = [
        ("c1", ("case", None), "x"), ("c2", ("case", None), "y"),
        ("a1", ("activity", "c1"), "x"), ("n1", ("note", "c1"), "x"), ("n2", ("note", "c2"), "x"),
        ("n3", ("note", "zz"), "y"),
    ]
    docs = spark.createDataFrame(rows, "_id string, join_field struct<name:string,parent:string>, b string")
    rels = {"case": ["activity", "note"]}
    notes = Relation.from_join_field(docs, child_role="note", relations=rels)
    acts = Relation.from_join_field(docs, child_role="activity", relations=rels)
    assert notes.parent_role == acts.parent_role == "case"
    got = {r["b"]: r["doc_count"] for r in parent_rollup(docs, notes, "b").collect()}
    assert got == {"x": 2, "y": 0}  # n1 -> c1, n2 -> c2; n3's parent is missing
    got = {r["b"]: r["doc_count"] for r in parent_rollup(docs, acts, "b").collect()}
    assert got == {"x": 1, "y": 0}
