"""Time the registered queries.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8), BENCH_REPEAT (default 3: best of N per query), BENCH_QUERIES
(comma list, default all), BENCH_EVENT_LOG (folder for Spark's event log).

Each query is run to completion through the ``noop`` sink (every row is
produced, nothing is collected to the driver). ``plain_form`` times the same two
form) in the same session and on the same cores. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from kinroll.registry import FLAGSHIP, QUERIES  # noqa: E402
from kinroll.session import get_session  # noqa: E402
from kinroll.sources import read_table  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def plain_form(spark, sf_dir: str, by: str):
    """Raw pairs dealt by key, distinct, joined, aggregated."""
    pairs = read_table(spark, sf_dir, "lineitem").filter("l_quantity > 10").select(by, "l_orderkey").repartition("l_orderkey").distinct()
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return pairs.join(orders, pairs["l_orderkey"] == orders["o_orderkey"], "left").groupBy(by).agg(
        F.count("o_orderkey").alias("doc_count"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("sp"))


PLAIN = {"rollup_orders_by_part": "l_partkey", "rollup_orders_by_flag": "l_returnflag"}


def best_time(build, repeat: int) -> float:
    times = []
    for _ in range(repeat):
        t0 = time.perf_counter()
        run(build())
        times.append(time.perf_counter() - t0)
    return round(min(times), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "3")))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(QUERIES)
    extra = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")}
    log_dir = os.environ.get("BENCH_EVENT_LOG")
    if log_dir:
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir})
    spark = get_session("kinroll-bench", master=f"local[{cpus}]", shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus * 2)),
                        extra_conf=extra)

    run(QUERIES[FLAGSHIP](spark, sf_dir))  # JVM and file-listing warm-up, not timed

    times = {name: best_time(lambda name=name: QUERIES[name](spark, sf_dir), repeat) for name in names}
    plain = {name: best_time(lambda by=by: plain_form(spark, sf_dir, by), repeat) for name, by in PLAIN.items() if name in times}

    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    try:
        sf = float(sf)
    except ValueError:
        pass
    print(json.dumps({
        "metric": "total_query_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "plain_form": plain,
        "sf": sf,
        "cpus": cpus,
        "repeat": repeat,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
