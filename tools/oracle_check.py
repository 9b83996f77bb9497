"""Run every registered query in Spark and its SQL in DuckDB; compare.

Usage: python tools/oracle_check.py [sf_dir] [query ...]
Prints one line per query: name, rows spark/duckdb, and whether columns and
values (order-insensitive) agree.
"""

from __future__ import annotations

import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from kinroll.sources import TABLES  # noqa: E402


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (1, repr(round(v, 6)))
    if hasattr(v, "item"):
        return _norm(v.item())
    return (1, repr(v))


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = sorted(tuple(_norm(r[i]) for i in order) for r in rows)
    return cols, out


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    t_spark = time.time() - t0
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    scols, s = canonical(sdf.columns, srows)
    dcols2, d = canonical(dcols, drows)
    return {
        "name": name,
        "rows": (len(srows), len(drows)),
        "columns": scols == dcols2,
        "values": s == d,
        "spark_cols": sdf.columns,
        "duck_cols": dcols,
        "sec": round(t_spark, 2),
        "diff": None if s == d else (sorted(set(s) - set(d))[:3], sorted(set(d) - set(s))[:3]),
    }


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    from kinroll.session import get_session
    from kinroll.registry import ORACLE_SQL, QUERIES

    spark = get_session(master="local[8]", shuffle_partitions=8)
    con = duckdb_connection(sf_dir)
    bad = 0
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        if name not in ORACLE_SQL:
            print(f"{name:32s} no oracle")
            continue
        r = compare(spark, con, name, fn, ORACLE_SQL[name], sf_dir)
        ok = r["columns"] and r["values"] and r["rows"][0] == r["rows"][1]
        bad += not ok
        print(f"{name:32s} {'OK ' if ok else 'BAD'} rows={r['rows']} cols={r['columns']} "
              f"vals={r['values']} {r['sec']}s")
        if not ok:
            print("   ", r["spark_cols"], r["duck_cols"], r["diff"])
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
