"""Properties of the roll-up, and a brute-force model on small random tables."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kinroll import Relation, merge_rollups, parent_rollup
from kinroll.sources import family_shards, read_table

from .conftest import SF01


def brute_force(children, parents, keep_empty=True):
    """{bucket: (parent count, sum of parent values)} the slow, obvious way."""
    pairs = set()
    buckets = set()
    for fk, b in children:
        buckets.add(b)
        if fk is not None:
            pairs.add((b, fk))
    out = {}
    for b in buckets:
        rows = [v for (bb, fk) in pairs if bb == b for pid, v in parents if pid == fk]
        if rows or keep_empty:
            out[b] = (len(rows), sum(rows) if rows else None)
    return out


keys = st.one_of(st.none(), st.integers(0, 6))
child_rows = st.lists(st.tuples(keys, st.sampled_from(["a", "b", "c", None])), max_size=25)
parent_rows = st.lists(st.tuples(st.integers(0, 8), st.integers(-5, 50)), max_size=12)


@settings(max_examples=16, deadline=None, suppress_health_check=list(HealthCheck))
@given(child_rows, parent_rows, st.booleans(), st.sampled_from(["map_side", "co_locate"]),
       st.sampled_from(["sum(v)", ("sum", "v")]))
def test_matches_brute_force(spark, children, parents, keep_empty, dedup, agg):
    kids = spark.createDataFrame(children, "fk long, b string")
    par = spark.createDataFrame(parents, "pid long, v long")
    rel = Relation.from_tables(par, child_key="fk", parent_key="pid")
    r = parent_rollup(kids, rel, "b", {"s": agg}, keep_empty=keep_empty, dedup=dedup)
    got = {x["b"]: (x["doc_count"], x["s"]) for x in r.collect()}
    assert got == brute_force(children, parents, keep_empty)


def _lineitem_rel(spark):
    li = read_table(spark, SF01, "lineitem").filter(F.col("l_quantity") > 30)
    orders = read_table(spark, SF01, "orders")
    return li, orders, Relation.from_tables(orders, child_key="l_orderkey", parent_key="o_orderkey")


def _d(df, key="l_returnflag"):
    return {r[key]: r["doc_count"] for r in df.collect()}


def test_partitioning_and_duplication_do_not_change_counts(spark):
    li, _, rel = _lineitem_rel(spark)
    base = _d(parent_rollup(li, rel, "l_returnflag"))
    assert _d(parent_rollup(li.repartition(13), rel, "l_returnflag")) == base
    assert _d(parent_rollup(li.unionByName(li), rel, "l_returnflag")) == base
    assert _d(parent_rollup(li, rel, "l_returnflag", dedup="co_locate")) == base


def test_count_bounded_by_parents(spark):
    li, orders, rel = _lineitem_rel(spark)
    n = orders.count()
    assert all(v <= n for v in _d(parent_rollup(li, rel, "l_returnflag")).values())


def test_family_shards_merge_to_whole(spark):
    li, _, rel = _lineitem_rel(spark)
    whole = _d(parent_rollup(li, rel, "l_returnflag"))
    shards = family_shards(li, "l_orderkey", 5)
    assert sum(s.count() for s in shards) == li.count()
    parts = [parent_rollup(s, rel, "l_returnflag") for s in shards]
    assert _d(merge_rollups(parts, "l_returnflag")) == whole


def test_merge_of_overlapping_parts_double_counts(spark):
    """Negative control: parts not split by family must not be merged."""
    li, _, rel = _lineitem_rel(spark)
    whole = _d(parent_rollup(li, rel, "l_returnflag"))
    by_line = [li.filter(F.col("l_linenumber") % 2 == i) for i in (0, 1)]
    merged = _d(merge_rollups([parent_rollup(p, rel, "l_returnflag") for p in by_line], "l_returnflag"))
    assert merged != whole


# ---- join-field layout, chains and family values against brute force

roles = st.sampled_from(["case", "activity", "note"])
ids = st.sampled_from(["a", "b", "c", "d"])
mixed_rows = st.lists(
    st.tuples(ids, roles, st.one_of(st.none(), ids), st.sampled_from(["x", "y", None]), st.integers(0, 9)),
    max_size=20,
)


def brute_force_join_field(docs, hits):
    buckets = {b for (_, _, _, b, _) in hits}
    pairs = {(b, p) for (_, role, p, b, _) in hits if role == "activity" and p is not None}
    parents = [(i, v) for (i, role, _, _, v) in docs if role == "case"]
    out = {}
    for b in buckets:
        vals = [v for (bb, p) in pairs if bb == b for (i, v) in parents if i == p]
        out[b] = (len(vals), sum(vals) if vals else None)
    return out


def _docs_df(spark, docs):
    rows = [(i, (role, p if role != "case" else None), b, v) for (i, role, p, b, v) in docs]
    return spark.createDataFrame(
        rows, "_id string, join_field struct<name:string,parent:string>, b string, v long")


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(mixed_rows, st.integers(0, 9))
def test_join_field_matches_brute_force(spark, docs, cut):
    docs = [(i, r, p if r != "case" else None, b, v) for (i, r, p, b, v) in docs]
    hits = [d for d in docs if d[4] <= cut]
    df = _docs_df(spark, docs)
    rel = Relation.from_join_field(df, child_role="activity", relations={"case": "activity"})
    r = parent_rollup(df.filter(F.col("v") <= cut), rel, "b", {"s": "sum(v)"})
    got = {x["b"]: (x["doc_count"], x["s"]) for x in r.collect()}
    assert got == brute_force_join_field(docs, hits)


three_levels = st.tuples(
    st.lists(st.tuples(st.integers(0, 5), st.sampled_from(["p", "q"])), max_size=15),  # child: (mid, bucket)
    st.lists(st.tuples(st.integers(0, 5), st.one_of(st.none(), st.integers(0, 3))), max_size=8),  # mid: (id, top)
    st.lists(st.tuples(st.integers(0, 3), st.integers(1, 9)), max_size=5),  # top: (id, w)
)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(three_levels, st.sampled_from(["sum(w)", ("sum", "w")]))
def test_chain_matches_brute_force(spark, data, agg):
    from kinroll import chain_rollup

    kids, mids, tops = data
    k = spark.createDataFrame(kids, "mid long, b string")
    m = spark.createDataFrame(mids, "mid_id long, top long")
    t = spark.createDataFrame(tops, "top_id long, w long")
    rels = [Relation.from_tables(m, child_key="mid", parent_key="mid_id"),
            Relation.from_tables(t, child_key="top", parent_key="top_id")]
    got = {x["b"]: (x["doc_count"], x["s"]) for x in chain_rollup(k, rels, "b", {"s": agg}).collect()}
    want = {}
    for b in {b for _, b in kids}:
        level1 = [(mid_id, top) for (mid_id, top) in mids if any(mm == mid_id and bb == b for mm, bb in kids)]
        keys = {top for (_, top) in level1 if top is not None}
        ws = [w for tk in keys for (top_id, w) in tops if top_id == tk]
        want[b] = (len(ws), sum(ws) if ws else None)
    assert got == want


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(mixed_rows)
def test_family_values_match_brute_force(spark, docs):
    from collections import Counter

    from kinroll import family_values

    docs = [(i, r, p if r != "case" else None, b, v) for (i, r, p, b, v) in docs]
    df = _docs_df(spark, docs)
    rel = Relation.from_join_field(df, child_role="activity", relations={"case": "activity"})
    got = {(x["family"], x["b"]): x["n"] for x in family_values(df, rel, "b", key_name="family").collect()}
    want = Counter()
    for (i, role, p, b, _) in docs:
        fam = i if role == "case" else (p if role == "activity" else None)
        if fam is not None and b is not None:
            want[(fam, b)] += 1
    assert got == dict(want)
