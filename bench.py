"""Benchmark: headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
``value`` is the sum of the headline query times.  One untimed warm-up query
runs first on the next smaller data set, so JVM start-up and JIT compilation
do not land on whichever query happens to be timed first; every timed query
then reads its inputs from scratch.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from panelforge.plans.analytics import Extracts  # noqa: E402
from panelforge.plans.refresh import init_targets, refresh  # noqa: E402
from panelforge.plans.registry import QUERIES  # noqa: E402
from panelforge.session import build_session, scratch_dir  # noqa: E402

HEADLINE = [
    "relationships",
    "gender_gap",
    "load_hours_worked",
    "stg_employed",
    "join_fanout",
    "upsert_sink",
    "partitioned_sink",
    "check_not_null",
    "pay_gap_trend",
    "gap_comovement",
]
WARMUP_DIRS = ("/root/testdata/sf0.01", "/root/testdata/sf0.001")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus, app_name="panelforge-bench",
                          driver_memory=os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
    scratch = scratch_dir(spark, "bench")

    warmup = [d for d in WARMUP_DIRS
              if os.path.isdir(d) and os.path.abspath(d) != os.path.abspath(sf_dir)]
    if warmup:
        QUERIES["gender_gap"](spark, warmup[0]).collect()

    times: dict[str, float | None] = {}
    errors: dict[str, str] = {}

    def timed(name: str, work) -> None:
        t = time.perf_counter()
        try:
            work()
            times[name] = round(time.perf_counter() - t, 3)
        except Exception as exc:  # report the item, keep the JSON line coming
            times[name] = None
            errors[name] = f"{type(exc).__name__}: {str(exc)[:200]}"

    for name in HEADLINE:
        timed(name, lambda name=name: QUERIES[name](spark, sf_dir).collect())

    def both_final_tables() -> None:
        extracts = Extracts(spark, sf_dir)
        extracts.final("relationships").collect()
        extracts.final("gender_gap").collect()

    timed("both_final_tables", both_final_tables)
    init_targets(spark, f"{scratch}/out")  # once per warehouse, so not part of a run
    timed("refresh_cloud", lambda: refresh(spark, sf_dir, f"{scratch}/out"))

    match = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(v for v in times.values() if v is not None), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(match.group(1)) if match else None,
        "cpus": cpus,
        **({"errors": errors} if errors else {}),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
