"""Benchmark the headline queries.

Runs at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` (default 8) and prints ONE JSON line::

    {"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is executed end to end through the ``noop`` sink (the whole plan
runs, nothing is collected to the driver); the reported time is the best of
``$BENCH_RUNS`` runs (default 2) after one warm-up of the mart.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from lanekit.plans import catalog  # noqa: E402
from lanekit.session import get_session  # noqa: E402
from lanekit.sources.scratch import release_all  # noqa: E402

HEADLINE = (
    "route_load_mart",        # flagship: 12-input mart, single-pass pre-aggregated measures
    "view_steps",             # the same mart as SQL steps
    "row_number_hot",         # a third of all rows under one key
    "export_all_roundtrip",   # all tables out and back
    "category_pivot_sum",
    "prorated_sum",
    "role_playing_join",
    "left_join_residual",
    "semi_join",
    "group_sum",
    "first_per_group",
    "row_number_rank",
    "line_tokens",
    "json_gzip_roundtrip",
)


def run_once(spark, fn, sf_dir: str) -> float:
    t = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    took = time.perf_counter() - t
    release_all(spark)                     # scratch tables do not pile up
    return took


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = max(1, int(os.environ.get("BENCH_RUNS", "2")))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    # local mode: the driver JVM is the only executor, so it gets the memory
    mem = os.environ.get("BENCH_DRIVER_MEMORY", "16g")
    spark = get_session(f"local[{cpus}]", app_name="lanekit-bench", shuffle_partitions=max(8, cpus * 2),
                        extra={"spark.driver.memory": mem})
    run_once(spark, catalog.QUERIES["route_load_mart"], sf_dir)      # warm-up (JVM, file listing)
    times: dict[str, float] = {}
    for name in names:
        fn = catalog.QUERIES[name]
        times[name] = round(min(run_once(spark, fn, sf_dir) for _ in range(runs)), 3)
        print(f"{name}: {times[name]}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else sf_dir
    print(json.dumps({"metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus, "runs": runs}))


if __name__ == "__main__":
    main()
