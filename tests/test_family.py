"""Family values and filters."""

import pytest
from pyspark.sql import functions as F

from kinroll import Relation, family_filter, family_values, filter_rows
from kinroll.sources import CASES_RELATIONS


def _rel(cases):
    return Relation.from_join_field(cases, child_role="activity", relations=CASES_RELATIONS)


def test_family_values_include_parent(cases):
    v = family_values(cases, _rel(cases), "action", key_name="family")
    got = {(r["family"], r["action"]): r["n"] for r in v.collect()}
    assert got == {
        ("case1", "actionA"): 2, ("case1", "actionB"): 1, ("case1", "actionC"): 2,
        ("case2", "actionB"): 2, ("case2", "actionC"): 1, ("case2", "actionD"): 1,
    }


def test_family_filter_keeps_whole_families(cases):
    rel = _rel(cases)
    kept = family_filter(cases, rel, cases, F.col("action") == "actionD", docs_key=rel.family_key)
    assert sorted(r["_id"] for r in kept.collect()) == [
        "activity5", "activity6", "activity7", "case2"]


def test_family_filter_typed_layout(spark):
    parents = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "pid long, tag string")
    kids = spark.createDataFrame([(1, "O"), (1, "F"), (2, "F")], "fk long, st string")
    rel = Relation.from_tables(parents, child_key="fk", parent_key="pid")
    kept = family_filter(parents, rel, kids, F.col("st") == "O")
    assert [r["pid"] for r in kept.collect()] == [1]
    kept = family_filter(parents, rel, kids, F.col("st") == "O", parent_condition=F.col("tag") == "z")
    assert sorted(r["pid"] for r in kept.collect()) == [1, 3]


def test_filter_rows(cases):
    assert filter_rows(cases).count() == 9
    assert filter_rows(cases, F.col("actionId") > 4).count() == 4
    with pytest.raises(TypeError):
        filter_rows(cases, F.col("actionId"))
    with pytest.raises(TypeError):
        filter_rows(cases, "actionId > 4")
