"""Shuffle volume and task counts per registered query, from Spark's event log.

    python tools/shuffle_profile.py SF_DIR query [query ...]

The event log goes to a fresh scratch folder (mktemp); no UI or server is started.
Prints one line per query: wall seconds, stages, tasks, shuffle records/bytes written, bytes read from files.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    sf, names = sys.argv[1], sys.argv[2:]
    log_dir = tempfile.mkdtemp(prefix="run-evlog-", dir="/tmp")
    from tilepulse.plans.registry import QUERIES
    from tilepulse.session import local_session

    spark = local_session(
        8, shuffle_partitions=16, app="shuffle-profile",
        **{"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir, "spark.eventLog.compress": "false"},
    )
    marks = {}
    for n in names:
        spark.sparkContext.setJobGroup(n, n)
        t0 = time.perf_counter()
        QUERIES[n](spark, sf).write.format("noop").mode("overwrite").save()
        marks[n] = time.perf_counter() - t0
    spark.stop()
    (root,) = glob.glob(os.path.join(log_dir, "*"))
    parts = sorted(glob.glob(os.path.join(root, "events_*"))) if os.path.isdir(root) else [root]
    job_group, stage_group = {}, {}
    agg = {n: {"stages": 0, "tasks": 0, "shuffle_records": 0, "shuffle_bytes": 0, "input_bytes": 0} for n in names}
    for line in (ln for p in parts for ln in open(p)):
        if True:
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                g = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                for sid in ev.get("Stage IDs", []):
                    stage_group[sid] = g
            elif kind == "SparkListenerStageCompleted":
                g = stage_group.get(ev["Stage Info"]["Stage ID"])
                if g in agg:
                    agg[g]["stages"] += 1
            elif kind == "SparkListenerTaskEnd":
                g = stage_group.get(ev.get("Stage ID"))
                if g not in agg:
                    continue
                m = ev.get("Task Metrics") or {}
                sw = m.get("Shuffle Write Metrics") or {}
                agg[g]["tasks"] += 1
                agg[g]["shuffle_records"] += sw.get("Shuffle Records Written", 0)
                agg[g]["shuffle_bytes"] += sw.get("Shuffle Bytes Written", 0)
                agg[g]["input_bytes"] += (m.get("Input Metrics") or {}).get("Bytes Read", 0)
    for n in names:
        print(json.dumps({"query": n, "sec": round(marks[n], 3), **agg[n]}))


if __name__ == "__main__":
    main()
