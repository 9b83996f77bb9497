"""Mergeable states, results per level, nested and declared buckets, whole-family
conditions and running totals, against plain Python over random rows."""

import random
import statistics
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from kinroll import (
    Relation,
    bucket_levels,
    bucket_tree,
    chain_levels,
    declared,
    family_counts,
    family_having,
    filter_buckets,
    finish_states,
    heavy_keys,
    lift_to_parents,
    merge_bitmaps,
    merge_states,
    only_live,
    parent_bitmaps,
    parent_rollup,
    partial_rollup,
    range_filters,
    running,
)
from kinroll.plans.strategy import physical_plan
from kinroll.registry import QUERIES
from kinroll.sources import family_shards

from .conftest import SF001

def executed_plan(df):
    df.collect()
    return physical_plan(df).split("== Initial Plan ==")[0]


HITS, PARENTS, TOPS = "b string, k long", "pid long, v long, g string", "gid string, w long"


def tables(seed=0, repeats=True):
    """Hits, parents (ids may repeat, some hits have none) and their own parents."""
    rng = random.Random(seed)
    hits = [(rng.choice(["a", "b", "c", None]), rng.choice([None, *range(14)])) for _ in range(120)] + [("lost", 99), ("none", None)]
    ids = list(range(10)) + ([1, 1, 2, 5] if repeats else [])
    parents = [(i, rng.choice([None, 1, 5, 9, 30]), rng.choice(["x", "y", "z", None])) for i in ids] + [(None, 7, "x")]
    tops = [("x", 1), ("y", 20)] + ([("y", 3)] if repeats else []) + [(None, 9)]
    return hits, parents, tops


def lifted(hits, parents):
    out = {b: [] for b, _ in hits}
    for b in out:
        keys = {k for x, k in hits if x == b and k is not None}
        out[b] = [p for p in parents if p[0] in keys]
    return out


def nulls_left(values):
    return [v for v in values if v is not None]


# ---- states ----

AGGS = {"n": ("count", "v"), "s": ("sum", "v"), "lo": ("min", "v"), "hi": ("max", "g"), "m": ("avg", "v"), "vp": ("var_pop", "v"),
        "sd": ("stddev_samp", "v"), "d": ("approx_count_distinct", "v"), "p": ("percentile", "v", 0.5)}


@pytest.mark.parametrize("seed,shards", [(1, 1), (2, 3)])
def test_states_merge_to_the_whole(spark, tmp_path, seed, shards):
    hits, parents, _ = tables(seed)
    rel = Relation.from_tables(spark.createDataFrame(parents, PARENTS), child_key="k", parent_key="pid")
    parts = [partial_rollup(h, rel, "b", AGGS, child_count="kids") for h in family_shards(spark.createDataFrame(hits, HITS), "k", shards)]
    parts[0].write.parquet(str(tmp_path / "part"))  # a part of another job: the kinds of its states are in the file
    parts[0] = spark.read.parquet(str(tmp_path / "part"))
    once = merge_states(parts[:1], "b")
    got = {r["b"]: r.asDict() for r in finish_states(merge_states([once, *parts[1:]], "b")).collect()}
    for b, rows in lifted(hits, parents).items():
        v, r = nulls_left([p[1] for p in rows]), got.pop(b)
        assert (r["doc_count"], r["kids"], r["n"], r["s"]) == (len(rows), sum(x == b for x, _ in hits), len(v), sum(v) if v else None)
        assert (r["lo"], r["hi"]) == (min(v, default=None), max(nulls_left([p[2] for p in rows]), default=None))
        assert r["m"] == (pytest.approx(statistics.mean(v)) if v else None)
        assert r["vp"] == (pytest.approx(statistics.pvariance(v)) if v else None)
        assert r["sd"] == (pytest.approx(statistics.stdev(v)) if len(v) > 1 else None)
        assert r["d"] == len(set(v))
        assert r["p"] is None if not v else statistics.median_low(v) <= r["p"] <= statistics.median_high(v)
    assert not got


def test_states_without_buckets_or_hits(spark):
    hits, parents, _ = tables(3)
    rel = Relation.from_tables(spark.createDataFrame(parents, PARENTS), child_key="k", parent_key="pid")
    none = spark.createDataFrame([], HITS)
    assert finish_states(merge_states([partial_rollup(none, rel, "b", AGGS)] * 2, "b")).count() == 0
    one = finish_states(merge_states([partial_rollup(none, rel, (), AGGS)] * 2)).first().asDict()
    assert one == {"doc_count": 0, "n": 0, "d": 0, **dict.fromkeys(("s", "lo", "hi", "m", "vp", "sd", "p"))}


@pytest.mark.parametrize("spec", [("median", "v"), "avg(v)", ("avg",), ("percentile", "v"), ("avg", "v", 0.5)])
def test_states_check_their_functions(spark, spec):
    hits, parents, _ = tables()
    rel = Relation.from_tables(spark.createDataFrame(parents, PARENTS), child_key="k", parent_key="pid")
    with pytest.raises(TypeError):
        partial_rollup(spark.createDataFrame(hits, HITS), rel, "b", {"x": spec})


def test_parts_must_hold_the_same_states(spark):
    hits, parents, _ = tables()
    rel = Relation.from_tables(spark.createDataFrame(parents, PARENTS), child_key="k", parent_key="pid")
    h = spark.createDataFrame(hits, HITS)
    with pytest.raises(ValueError, match="different states"):
        merge_states([partial_rollup(h, rel, "b", {"x": ("avg", "v")}), partial_rollup(h, rel, "b", {"x": ("avg", "pid")})], "b")
    with pytest.raises(ValueError, match="nothing"):
        merge_states([], "b")


def test_bitmaps_count_overlapping_runs_once(spark):
    far = [(i * 40_000 - 100_000, 1, "x") for i in range(8)] + [(7, 1, "x")]
    hits = [(b, p[0]) for b in "ab" for p in far if (p[0] // 7) % 3 != ord(b) % 3] + [("lost", 123)]
    rel = Relation.from_tables(spark.createDataFrame(far, PARENTS), child_key="k", parent_key="pid")
    runs = [hits[::2] + hits[1:9:4], hits[1::2], [("only", 7)]]
    parts = [parent_bitmaps(spark.createDataFrame(r, HITS), rel, "b") for r in runs]
    got = {r["b"]: (r["doc_count"], r["again"]) for r in merge_bitmaps(parts, "b", repeated="again").collect()}
    each = [{b: {p[0] for p in rows} for b, rows in lifted(r, far).items()} for r in runs]
    want = {b: set().union(*(e.get(b, set()) for e in each)) for b in ("a", "b", "lost", "only")}
    assert got == {b: (len(ids), sum(len(e.get(b, ())) for e in each) - len(ids)) for b, ids in want.items()}
    with pytest.raises(TypeError, match="integer"):
        parent_bitmaps(spark.createDataFrame([("a", "x")], "b string, g string"),
                       Relation.from_tables(spark.createDataFrame([("x", 1)], TOPS), child_key="g", parent_key="gid"), "b")


# ---- levels ----

@pytest.mark.parametrize("seed,unique", [(1, False), (2, False), (3, True)])
def test_chain_levels(spark, seed, unique):
    hits, parents, tops = tables(seed, repeats=not unique)
    low = Relation.from_tables(spark.createDataFrame(parents, PARENTS), child_key="k", parent_key="pid", unique_parents=unique)
    high = Relation.from_tables(spark.createDataFrame(tops, TOPS), child_key="g", parent_key="gid", unique_parents=unique)
    levels = [("ps", low, {"v": ("sum", "v"), "nv": ("count", "v")}), ("ts", high, {"w": ("max", "w")})]
    got = {r["b"]: tuple(r)[1:] for r in chain_levels(spark.createDataFrame(hits, HITS), levels, "b", child_count="kids").collect()}
    want = {}
    for b, rows in lifted(hits, parents).items():
        v = nulls_left([p[1] for p in rows])
        up = [t for t in tops if t[0] in set(nulls_left([p[2] for p in rows]))]
        want[b] = (sum(x == b for x, _ in hits), len(rows), sum(v) if v else None, len(v), len(up), max((t[1] for t in up), default=None))
    assert got == want
    whole = chain_levels(spark.createDataFrame([], HITS), levels, child_count="kids")
    assert [tuple(r) for r in whole.collect()] == [(0, 0, None, 0, 0, None)]


def test_chain_levels_checks(spark):
    hits, parents, _ = tables()
    rel = Relation.from_tables(spark.createDataFrame(parents, PARENTS), child_key="k", parent_key="pid")
    h = spark.createDataFrame(hits, HITS)
    with pytest.raises(ValueError, match="at least one"):
        chain_levels(h, [], "b")
    with pytest.raises(ValueError, match="repeat"):
        chain_levels(h, [("b", rel)], "b")
    with pytest.raises(TypeError, match="pairs"):
        chain_levels(h, [("n", rel, {"x": "avg(v)"})], "b")


def test_chain_levels_read_the_hits_once(spark):
    df = QUERIES["rollup_chain_levels"](spark, SF001)
    plan = executed_plan(df)
    assert len([x for x in plan.splitlines() if "FileScan" in x and "l_orderkey" in x]) == 1
    assert "Cartesian" not in plan and "SinglePartition" not in plan


@pytest.mark.parametrize("dedup", ["map_side", "co_locate"])
def test_bucket_levels_and_tree(spark, dedup):
    hits, parents, _ = tables(4)
    parents = [(*p, ("l", "r")[p[1] is not None and p[1] > 4]) for p in parents]
    rel = Relation.from_tables(spark.createDataFrame(parents, PARENTS + ", h string"), child_key="k", parent_key="pid")
    h = spark.createDataFrame(hits, HITS)
    rows = bucket_levels(h, rel, "b", ["g", "h"], {"d": "count(DISTINCT v)"}, dedup=dedup)
    groups = defaultdict(list)
    for b, ps in lifted(hits, parents).items():
        groups[0, b, None, None] += ps
        for p in ps:
            groups[1, b, p[2], None].append(p)
            groups[2, b, p[2], p[3]].append(p)
    assert {tuple(r) for r in rows.collect()} == {(*k, len(ps), len(set(nulls_left([p[1] for p in ps])))) for k, ps in groups.items()}
    assert rows.count() == len(groups)
    tree = bucket_tree(h, rel, "b", "g", {"s": ("sum", "v")}, dedup=dedup)
    for r in tree.collect():
        inner = {k[2]: ps for k, ps in groups.items() if k[0] == 1 and k[1] == r["b"]}
        total = lambda ps: sum(nulls_left([p[1] for p in ps])) if nulls_left([p[1] for p in ps]) else None
        assert [tuple(x) for x in r["buckets"]] == [(g, len(ps), total(ps)) for g, ps in sorted(inner.items(), key=lambda x: x[0] or "")]
        assert (r["doc_count"], r["s"]) == (len(groups[0, r["b"], None, None]), total(groups[0, r["b"], None, None]))
    with pytest.raises(ValueError):
        bucket_levels(h, rel, "b", "absent")
    with pytest.raises(ValueError):
        bucket_levels(h, rel, "b", [])


@pytest.mark.parametrize("dedup", ["map_side", "co_locate"])
def test_bucket_levels_hold_a_distinct_value_once(spark, dedup):
    hits, parents, _ = tables(5)
    rel = Relation.from_tables(spark.createDataFrame([(*p, "lr"[(p[1] or 0) > 4]) for p in parents], PARENTS + ", h string"),
                               child_key="k", parent_key="pid")
    aggs = {"d": "count(DISTINCT coalesce(v, -1))", "n": "count(*)", "m": "Count(v)", "s": ("sum", "v"), "low": "min(v)", "high": "max(pid)"}
    h = spark.createDataFrame(hits, HITS)
    df = bucket_levels(h, rel, "b", ["g", "h"], aggs, dedup=dedup)
    plan = executed_plan(df)  # the join's rows are grouped once, not once a level and again for the distinct values
    assert plan.count("Expand") == 1 and plan.index("Expand") < plan.index("Window") < plan.index("Join")
    # an aggregate that does not split takes the expanding plan: both give the same
    other = bucket_levels(h, rel, "b", ["g", "h"], aggs | {"mean": "avg(v)"}, dedup=dedup).drop("mean")
    assert executed_plan(other).count("Expand") > 1 and df.schema.simpleString() == other.schema.simpleString()
    found = Counter(map(tuple, df.collect()))
    assert found == Counter(map(tuple, other.collect())) and max(found.values()) == 1
    groups = defaultdict(list)
    for b, ps in lifted(hits, parents).items():
        groups[b] += ps
    tops = {r["b"]: r for r in df.filter("level = 0").collect()}
    assert set(tops) == set(groups)
    for b, ps in groups.items():
        assert (tops[b]["d"], tops[b]["n"], tops[b]["m"]) == (len({-1 if p[1] is None else p[1] for p in ps}), len(ps), len(nulls_left([p[1] for p in ps])))


def test_bucket_levels_without_hits_or_buckets(spark):
    hits, parents, _ = tables(6)
    rel = Relation.from_tables(spark.createDataFrame(parents, PARENTS), child_key="k", parent_key="pid")
    aggs = {"d": "count(DISTINCT v)"}
    assert bucket_levels(spark.createDataFrame([], HITS), rel, "b", "g", aggs).count() == 0
    absent = bucket_levels(spark.createDataFrame([("x", 99), ("y", None)], HITS), rel, "b", "g", aggs).collect()
    assert {tuple(r) for r in absent} == {(0, "x", None, 0, 0), (0, "y", None, 0, 0)}


# ---- declared buckets ----

def test_declared_ranges(spark):
    hits, parents, _ = tables(5)
    rel = Relation.from_tables(spark.createDataFrame(parents, PARENTS), child_key="k", parent_key="pid")
    ranges = {"low": (None, 4), "mid": (2, 9), "far": (50, 60), "all": (None, None)}
    rows = filter_buckets(spark.createDataFrame(hits, HITS), range_filters("k", ranges), "r")
    got = declared(parent_rollup(rows, rel, "r", {"s": ("sum", "v")}, child_count="kids"), [*ranges, "far"], "r", zero=("doc_count", "kids"))
    inside = {n: [("x", k) for _, k in hits if k is not None and (lo is None or k >= lo) and (hi is None or k < hi)]
              for n, (lo, hi) in ranges.items()}
    want = set()
    for n, kept in inside.items():
        ps = lifted(kept, parents).get("x", [])
        v = nulls_left([p[1] for p in ps])
        want.add((n, len(ps), len(kept), sum(v) if v else None))
    assert {tuple(r) for r in got.collect()} == want and got.count() == len(ranges)
    with pytest.raises(ValueError):
        filter_buckets(rows, {"x": F.lit(True)}, "r")
    with pytest.raises(ValueError):
        filter_buckets(rows, {})


# ---- whole families ----

def test_family_having(spark):
    rng = random.Random(6)
    parents = [(i, None, "x") for i in range(20)] + [(3, 1, "again"), (None, 1, "no id")]
    kids = [(rng.choice(["o", "f", None]), rng.choice([None, *range(15)])) for _ in range(90)]
    docs, members = spark.createDataFrame(parents, PARENTS), spark.createDataFrame(kids, HITS)
    rel = Relation.from_tables(docs, child_key="k", parent_key="pid")
    counts = {"open": F.col("b") == "o", "closed": F.col("b") == "f"}
    family = {p[0]: [b for b, k in kids if k is not None and k == p[0]] for p in parents}
    for having, holds in (
        ("open = size", lambda m: all(b == "o" for b in m)), ("open = 0", lambda m: "o" not in m),
        ("closed >= 2 AND size >= 3", lambda m: m.count("f") >= 2 and len(m) >= 3), ("open > 0 AND closed > 0", lambda m: {"o", "f"} <= set(m)),
    ):
        kept = family_having(docs, rel, members, counts, having)
        assert kept.columns == docs.columns
        assert sorted(map(repr, (tuple(r) for r in kept.collect()))) == sorted(repr(p) for p in parents if holds(family[p[0]]))
    sizes = family_counts(members, rel, counts, key_name="fam")
    assert {tuple(r) for r in sizes.collect()} == {(i, len(m), m.count("o"), m.count("f")) for i, m in family.items() if m}
    with pytest.raises(TypeError):
        family_having(docs, rel, members, counts, "open + 1")
    with pytest.raises(ValueError):
        family_having(docs, rel, members, {}, "true")


def test_family_counts_combine_a_hot_family_map_side(spark):
    kids = spark.range(60_000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("k"), (F.col("id") % 2).alias("o"))
    rel = Relation.from_tables(spark.range(100).withColumnRenamed("id", "pid"), child_key="k", parent_key="pid")
    df = family_counts(kids, rel, {"odd": F.col("o") == 1})
    assert df.filter("pid = 7").first()["size"] == 40_000
    assert "partial_sum" in executed_plan(df)


# ---- running totals ----

def test_running(spark):
    rng = random.Random(7)
    rows = [(i, rng.choice(["p", "q"]), rng.choice([None, 1, 2, 50])) for i in rng.sample(range(1000), 300)]
    df = spark.createDataFrame(rows, "i long, s string, n long").repartition(5)
    got = running(df, ["s", "i"], {"total": "n"}, {"step": "n"})
    assert got.columns == ["i", "s", "n", "total", "step"]
    want, total, last = set(), None, None
    for k, (i, s, n) in enumerate(sorted(rows, key=lambda r: (r[1], r[0]))):
        total = total if n is None else (total or 0) + n
        want.add((i, s, n, total, n - last if k and None not in (n, last) else None))
        last = n
    assert {tuple(r) for r in got.collect()} == want
    assert running(df.limit(0), "i", {"t": "n"}).count() == 0
    with pytest.raises(ValueError):
        running(df, "i")


# ---- stored families ----

def test_stored_rollup_has_no_exchange_before_its_join(spark):
    df = QUERIES["rollup_stored"](spark, SF001)
    plan = executed_plan(df)
    below = plan[plan.index("Join"):]
    assert "Exchange" not in below and "Exchange hashpartitioning" in plan


# ---- plans for heavy keys and few parents ----

@pytest.mark.parametrize("heavy", [[3], [None, 3, 77], [None], []])
def test_split_plan_agrees(spark, heavy):
    hits, parents, _ = tables(8)
    rel = Relation.from_tables(spark.createDataFrame(parents, PARENTS), child_key="k", parent_key="pid")
    h, aggs = spark.createDataFrame(hits, HITS), {"s": ("sum", "v"), "n": ("count", "v"), "hi": ("max", "g")}
    for kw in ({}, {"keep_empty": False}, {"child_count": "kids", "metadata": {"k": 1}}):
        plain = parent_rollup(h, rel, "b", aggs, **kw)
        split = parent_rollup(h, rel, "b", aggs, dedup="split", heavy=heavy, **kw)
        assert split.dtypes == plain.dtypes and split.schema["doc_count"].metadata == plain.schema["doc_count"].metadata
        assert {tuple(r) for r in split.collect()} == {tuple(r) for r in plain.collect()}
    assert [tuple(r) for r in parent_rollup(h.limit(0), rel, (), aggs, dedup="split", heavy=heavy).collect()] == [(0, None, 0, None)]
    with pytest.raises(ValueError, match="pairs"):
        parent_rollup(h, rel, "b", {"s": "sum(v)"}, dedup="split")
    with pytest.raises(ValueError, match="parent_rollup"):
        lift_to_parents(h, rel, "b", dedup="split")


def test_heavy_keys_of_a_sample(spark):
    kids = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id")).alias("k"), (F.col("id") % 5).alias("b"))
    parents = spark.range(60_000).select(F.col("id").alias("pid"), F.lit(2).alias("v"))
    rel = Relation.from_tables(parents, child_key="k", parent_key="pid")
    assert sorted(heavy_keys(kids, rel), key=str) == [7, None]
    assert heavy_keys(kids.filter("k <> 7"), rel) == []
    split = parent_rollup(kids, rel, "b", {"s": ("sum", "v")}, dedup="split")
    assert {tuple(r) for r in split.collect()} == {tuple(r) for r in parent_rollup(kids, rel, "b", {"s": ("sum", "v")}).collect()}
    assert heavy_keys(kids.limit(0), rel) == []
    with pytest.raises(ValueError):
        heavy_keys(kids, rel, share=2)


def test_only_live_reduces_before_the_shuffle(spark):
    hits, parents, _ = tables(9)
    rel = Relation.from_tables(spark.createDataFrame(parents[:4], PARENTS), child_key="k", parent_key="pid")
    h = spark.createDataFrame(hits, HITS)
    for most in (10, 2):  # beyond the bound all hits stay
        kept = only_live(h, rel, max_keys=most)
        assert kept.columns == h.columns and (kept.count() < len(hits)) == (most == 10)
        got = parent_rollup(kept, rel, "b", {"s": ("sum", "v")}, keep_empty=False)
        assert {tuple(r) for r in got.collect()} == {tuple(r) for r in parent_rollup(h, rel, "b", {"s": ("sum", "v")}, keep_empty=False).collect()}
    plan = executed_plan(QUERIES["rollup_live_reduced"](spark, SF001))
    at = next(i for i, x in enumerate(plan.splitlines()) if "LeftSemi" in x)
    assert "BroadcastHashJoin" in plan.splitlines()[at] and "Exchange hash" not in "".join(plan.splitlines()[at + 1:at + 5])
