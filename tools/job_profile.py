"""Job and stage timings of one registered query, from Spark's event log.

Usage: python tools/job_profile.py <query> [sf_dir]

The query runs twice in one session (the first run warms the JVM); the event
log of the second run is written to a fresh scratch folder and summarised:
jobs, stages, time with a job running, time between jobs (driver work), and
the slowest stages.  No UI or REST endpoint is used.
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
    name = sys.argv[1]
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.01"
    log_dir = tempfile.mkdtemp(prefix="panelforge-events-")
    from panelforge.session import build_session
    from panelforge.plans.registry import QUERIES
    spark = build_session("local[8]", 8, conf={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                                               "spark.eventLog.compress": "false"})
    QUERIES[name](spark, sf_dir).collect()
    start = time.time() * 1000
    QUERIES[name](spark, sf_dir).collect()
    end = time.time() * 1000
    spark.stop()

    jobs: dict[int, list[float]] = {}
    stages: list[tuple[float, int, str]] = []
    for path in glob.glob(f"{log_dir}/*/events_*") + glob.glob(f"{log_dir}/*[!/]"):
        if os.path.isdir(path):
            continue
        for line in open(path):
            e = json.loads(line)
            if e["Event"] == "SparkListenerJobStart" and e["Submission Time"] >= start:
                jobs[e["Job ID"]] = [e["Submission Time"], e["Submission Time"]]
            elif e["Event"] == "SparkListenerJobEnd" and e["Job ID"] in jobs:
                jobs[e["Job ID"]][1] = e["Completion Time"]
            elif e["Event"] == "SparkListenerStageCompleted":
                info = e["Stage Info"]
                if (info.get("Submission Time") or 0) >= start:
                    stages.append((info["Completion Time"] - info["Submission Time"],
                                   info["Number of Tasks"], info["Stage Name"][:60]))
    busy, last = 0.0, start
    for s, e in sorted(jobs.values()):
        busy += max(0.0, e - max(s, last))
        last = max(last, e)
    total = end - start
    print(f"{name}: {total / 1000:.2f} s, {len(jobs)} jobs, {len(stages)} stages, "
          f"jobs running {busy / 1000:.2f} s, driver gaps {(total - busy) / 1000:.2f} s")
    for ms, tasks, stage in sorted(stages, reverse=True)[:8]:
        print(f"  {ms / 1000:6.2f} s  {tasks:4d} tasks  {stage}")
    print(f"event log: {log_dir}")


if __name__ == "__main__":
    main()
