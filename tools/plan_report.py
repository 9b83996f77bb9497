"""Write PLANS.md: for every registered query, the final adaptive plan's
exchanges, reuse, joins, scanned columns and pushed filters.

Usage: python tools/plan_report.py [sf_dir] [out.md]
Runs each query once (results are collected: use a small scale factor).
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def summarise(df) -> dict:
    df.collect()
    from kinroll.plans.strategy import physical_plan

    text = physical_plan(df)
    final = text.split("== Initial Plan ==")[0]
    lines = final.splitlines()

    def count(pattern):
        return sum(bool(re.search(pattern, ln)) for ln in lines)

    scans = []
    for ln in lines:
        m = re.search(r"FileScan parquet .*Location: [^\[]*\[file:([^\]]+)\].*PushedFilters: \[([^\]]*)\], "
                      r"ReadSchema: struct<(.*)>", ln)
        if m:
            table = os.path.basename(m.group(1)).removesuffix(".parquet")
            cols = [c.split(":")[0] for c in re.split(r",(?![^<]*>)", m.group(3))]
            scans.append((table, cols, m.group(2)))
    return {
        "initial": len(re.findall(r"Exchange hashpartitioning", text.split("== Initial Plan ==")[-1])),
        "exchanges": count(r"Exchange hashpartitioning") - count(r"ReusedExchange"),
        "reused": count(r"ReusedExchange"),
        "round_robin": count(r"RoundRobinPartitioning"),
        "smj": count(r"SortMergeJoin"),
        "skew_smj": count(r"SortMergeJoin\(skew=true\)"),
        "bhj": count(r"BroadcastHashJoin"),
        "semi": count(r"LeftSemi"),
        "scans": scans,
    }


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    out = argv[2] if len(argv) > 2 else os.path.join(ROOT, "PLANS.md")
    from kinroll.registry import QUERIES
    from kinroll.session import get_session

    spark = get_session("kinroll-plans", master="local[8]", shuffle_partitions=16,
                        extra_conf={"spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    rows = []
    for name, fn in QUERIES.items():
        s = summarise(fn(spark, sf_dir))
        scans = "; ".join(f"{t}({', '.join(c)})" + (f" pushed [{p}]" if p else "") for t, c, p in s["scans"])
        rows.append(f"| `{name}` | {s['initial']} | {s['exchanges']} | {s['reused']} | {s['round_robin']} | "
                    f"{s['smj']} ({s['skew_smj']} split) | {s['bhj']} | {scans} |")
    with open(out, "w") as fh:
        fh.write(
            "# Plans of the registered queries\n\n"
            f"Adaptive plans at `{sf_dir}`, local[8], 16 shuffle partitions, written by "
            "`tools/plan_report.py`, with every broadcast off, i.e. as they stay on large tables. Initial "
            "exchanges are those planned, before any is found to be reusable; the final ones exclude reused ones. "
            "Scans list the columns read and the filters pushed into Parquet.\n\n"
            "| query | initial exchanges | hash exchanges | reused | round-robin | sort-merge joins | broadcast joins | scans |\n"
            "| --- | --- | --- | --- | --- | --- | --- | --- |\n" + "\n".join(rows) + "\n")
    print(out)


if __name__ == "__main__":
    main(sys.argv)
