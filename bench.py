"""Benchmark: run every registered query on ``$BENCH_SF_DIR`` with
``local[$BENCH_CPUS]`` and print one JSON line.

Each query is executed in full through the ``noop`` sink (every row is
produced, nothing is collected to the driver); queries share no results.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from chainscope.plans import queries as registry  # noqa: E402
from chainscope.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = sys.argv[1:]
    spark = local_session(cpus, shuffle_partitions=max(2 * cpus, 8), app_name="chainscope-bench")
    # Warm-up on the smallest tables, not timed: class loading, code
    # generation, Python/Arrow workers and the first Parquet read/write would
    # otherwise be charged to whichever query touches them first.
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for name in ("wash_sets", "cycles_3", "monthly_count_sum"):
            registry.QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name, fn in registry.QUERIES.items():
        if only and name not in only:
            continue
        t0 = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
