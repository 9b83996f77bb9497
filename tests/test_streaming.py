"""The streaming roll-up ends where the batch roll-up over all hits is."""

import os
import tempfile

from pyspark.sql import functions as F

from kinroll import Relation, parent_rollup
from kinroll.sources import read_table
from kinroll.streaming import start_rollup_stream, stream_parent_rollup

from .conftest import SF001


def test_stream_matches_batch(spark):
    lines = read_table(spark, SF001, "lineitem").filter(F.col("l_quantity") > 45)
    orders = read_table(spark, SF001, "orders").filter(F.col("o_orderstatus") != "P")
    rel = Relation.from_tables(orders, child_key="l_orderkey", parent_key="o_orderkey")
    folder = tempfile.mkdtemp(prefix="kinroll-stream-")
    # three arrivals of hits: the flags arrive in separate files
    for flag in ("A", "N", "R"):
        lines.filter(F.col("l_returnflag") == flag).write.mode("append").parquet(folder)
    stream = (spark.readStream.schema(lines.schema).option("maxFilesPerTrigger", 1).parquet(folder))
    out = stream_parent_rollup(stream, rel, "l_partkey", {"sp": "sum(o_totalprice)", "mx": ("max", "o_totalprice")})
    q = start_rollup_stream(out, "kinroll_stream_test", sink="memory", output_mode="complete",
                            checkpoint=os.path.join(folder, "_checkpoint"))
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = {r["l_partkey"]: (r["doc_count"], r["sp"]) for r in spark.table("kinroll_stream_test").collect()}
    want = {r["l_partkey"]: (r["doc_count"], r["sp"])
            for r in parent_rollup(lines, rel, "l_partkey", {"sp": "sum(o_totalprice)"}).collect()}
    mx = {r["l_partkey"]: r["mx"] for r in spark.table("kinroll_stream_test").collect()}
    assert mx == {r["l_partkey"]: r["mx"] for r in
                  parent_rollup(lines, rel, "l_partkey", {"mx": "max(o_totalprice)"}).collect()}
    assert got.keys() == want.keys()
    for k, (n, s) in want.items():
        assert got[k][0] == n
        assert (s is None and got[k][1] is None) or abs(got[k][1] - s) < 1e-6
    assert any(n == 0 for n, _ in want.values())


def test_stream_rejects_table(spark):
    import pytest

    lines = read_table(spark, SF001, "lineitem")
    rel = Relation.from_tables(read_table(spark, SF001, "orders"), child_key="l_orderkey",
                               parent_key="o_orderkey")
    with pytest.raises(ValueError):
        stream_parent_rollup(lines, rel, "l_returnflag")


def test_stream_state_checkpoint_defaults_to_session_folder(spark):
    from kinroll.session import ensure_checkpoint_dir

    lines = read_table(spark, SF001, "lineitem")
    folder = tempfile.mkdtemp(prefix="kinroll-stream2-")
    lines.write.mode("append").parquet(folder)
    rel = Relation.from_tables(read_table(spark, SF001, "orders"), child_key="l_orderkey",
                               parent_key="o_orderkey")
    out = stream_parent_rollup(spark.readStream.schema(lines.schema).parquet(folder), rel, "l_returnflag")
    q = start_rollup_stream(out, "kinroll_stream_default_ckpt", sink="memory")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    base = ensure_checkpoint_dir(spark).removeprefix("file:")
    assert os.path.isdir(os.path.join(base, "kinroll_stream_default_ckpt"))
    got = {r[0]: r[1] for r in spark.table("kinroll_stream_default_ckpt").collect()}
    want = {r[0]: r[1] for r in parent_rollup(lines, rel, "l_returnflag").collect()}
    assert got == want


def test_stream_per_key_plan(spark):
    lines = read_table(spark, SF001, "lineitem").filter(F.col("l_quantity") > 45)
    orders = read_table(spark, SF001, "orders").filter(F.col("o_orderstatus") != "P")
    rel = Relation.from_tables(orders, child_key="l_orderkey", parent_key="o_orderkey")
    folder = tempfile.mkdtemp(prefix="kinroll-stream3-")
    lines.write.mode("append").parquet(folder)
    out = stream_parent_rollup(spark.readStream.schema(lines.schema).parquet(folder), rel, "l_partkey",
                               {"s": ("sum", "o_totalprice"), "n": ("count", "*")})
    q = start_rollup_stream(out, "kinroll_stream_per_key", sink="memory", output_mode="complete",
                            checkpoint=os.path.join(folder, "_ckpt"))
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    norm = lambda rows: sorted((r[0], r[1], None if r[2] is None else round(r[2], 4), r[3]) for r in rows)
    got = norm(spark.table("kinroll_stream_per_key").select("l_partkey", "doc_count", "s", "n").collect())
    want = norm(parent_rollup(lines, rel, "l_partkey", {"s": "sum(o_totalprice)", "n": "count(*)"})
                .select("l_partkey", "doc_count", "s", "n").collect())
    assert got == want


def test_batch_operators_refuse_a_stream(spark):
    import pytest

    lines = read_table(spark, SF001, "lineitem")
    folder = tempfile.mkdtemp(prefix="kinroll-stream4-")
    lines.write.mode("append").parquet(folder)
    stream = spark.readStream.schema(lines.schema).parquet(folder)
    rel = Relation.from_tables(read_table(spark, SF001, "orders"), child_key="l_orderkey",
                               parent_key="o_orderkey")
    with pytest.raises(ValueError, match="stream_parent_rollup"):
        parent_rollup(stream, rel, "l_returnflag")
