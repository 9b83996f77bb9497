"""The reference's only test, with its golden values."""

from pyspark.sql import functions as F

from kinroll import Relation, parent_rollup, term_buckets
from kinroll.functions import bucket_counts, side_by_side
from kinroll.sources import CASES_RELATIONS


def _hits(cases):
    return cases.filter(F.col("type") == "activity")


def test_hit_total(cases):
    assert _hits(cases).count() == 7


def test_term_and_parent_counts(cases):
    hits = term_buckets(_hits(cases), "action", "term")
    rel = Relation.from_join_field(cases, child_role="activity", relations=CASES_RELATIONS)
    parents = parent_rollup(hits, rel, "term")
    both = side_by_side(bucket_counts(hits, "term", "children"), parents, "term")
    got = {r["term"]: (r["children"], r["doc_count"]) for r in both.collect()}
    assert len(got) == 4
    assert got == {"actiona": (1, 1), "actionb": (2, 2), "actionc": (3, 2), "actiond": (1, 1)}


def test_child_count_in_one_pass(cases):
    hits = term_buckets(_hits(cases), "action", "term")
    rel = Relation.from_join_field(cases, child_role="activity", relations=CASES_RELATIONS)
    r = parent_rollup(hits, rel, "term", child_count="children")
    got = {x["term"]: (x["children"], x["doc_count"]) for x in r.collect()}
    assert got == {"actiona": (1, 1), "actionb": (2, 2), "actionc": (3, 2), "actiond": (1, 1)}


def test_sub_aggregation_runs_on_parents(cases):
    hits = term_buckets(_hits(cases), "action", "term")
    rel = Relation.from_join_field(cases, child_role="activity", relations=CASES_RELATIONS)
    r = parent_rollup(hits, rel, "term", {"parent_ids": "sum(actionId)", "rows": "count(*)"})
    got = {x["term"]: (x["parent_ids"], x["rows"]) for x in r.collect()}
    # case1 has actionId 1, case2 has 2: sums of the parents, not of the children
    assert got == {"actiona": (1, 1), "actionb": (3, 2), "actionc": (3, 2), "actiond": (2, 1)}


def test_order_independent(cases):
    rel = Relation.from_join_field(cases, child_role="activity", relations=CASES_RELATIONS)
    shuffled = cases.orderBy(F.rand(7)).repartition(5)
    a = parent_rollup(term_buckets(_hits(cases), "action", "term"), rel, "term").collect()
    b = parent_rollup(term_buckets(_hits(shuffled), "action", "term"), rel, "term").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
