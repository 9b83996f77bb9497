"""Summarise a Spark event log (zstd or plain): wall time per job and per stage.

Usage: python tools/stage_times.py <event-log folder>
"""

import glob
import io
import json
import sys


def _lines(path):
    if path.endswith(".zstd"):
        import zstandard

        with open(path, "rb") as fh:
            reader = zstandard.ZstdDecompressor().stream_reader(fh)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def main(folder):
    files = sorted(f for f in glob.glob(folder + "/**/events_*", recursive=True))
    stages, jobs, tasks = {}, {}, {}
    for f in files:
        for line in _lines(f):
            e = json.loads(line)
            ev = e["Event"]
            if ev == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                stages[si["Stage ID"]] = (si["Number of Tasks"], si["Completion Time"] - si["Submission Time"])
            elif ev == "SparkListenerTaskEnd":
                m = e.get("Task Metrics") or {}
                t = tasks.setdefault(e["Stage ID"], {"run": 0, "cpu": 0, "gc": 0, "rows_in": 0, "shuffle_read": 0,
                                                   "shuffle_write": 0})
                t["run"] += m.get("Executor Run Time", 0)
                t["cpu"] += m.get("Executor CPU Time", 0) // 1_000_000
                t["gc"] += m.get("JVM GC Time", 0)
                t["rows_in"] += (m.get("Input Metrics") or {}).get("Records Read", 0)
                sr = m.get("Shuffle Read Metrics") or {}
                t["shuffle_read"] += sr.get("Total Records Read", 0)
                t["shuffle_write"] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Records Written", 0)
            elif ev == "SparkListenerJobStart":
                jobs[e["Job ID"]] = [e["Submission Time"], e["Stage IDs"], None]
            elif ev == "SparkListenerJobEnd":
                jobs[e["Job ID"]][2] = e["Completion Time"]
    for j, (t0, sids, t1) in sorted(jobs.items()):
        ran = {s: stages[s] for s in sids if s in stages}
        print(f"job {j}: {t1 - t0} ms; stages (tasks, ms): {ran}")
        for sid in ran:
            print(f"    stage {sid}: {tasks.get(sid)}")


if __name__ == "__main__":
    main(sys.argv[1])
