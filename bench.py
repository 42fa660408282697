"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 BENCH_RUNS=3 python bench.py

Each query runs to completion through the ``noop`` sink (full execution,
nothing collected to the driver).  The numbers are steady-state: every
headline query first runs once on the smallest scale factor next to
``BENCH_SF_DIR`` (JVM start-up, JIT and code generation), then each is
timed ``BENCH_RUNS`` times at the target scale and the median is reported.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from emporia.plans.catalog import QUERIES  # noqa: E402
from emporia.session import get_session  # noqa: E402

HEADLINE = [
    "gmv_topn_report",
    "page_views",
    "keyword_top10",
    "login_regions",
    "path_transitions",
    "device_users",
    "repeat_rate_desc",
    "change_current_state",
    "dws_store_category_daycount",
    "one_shot_ads",
    "audience_ratio",
    "page_links",
]


def main() -> None:
    base = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = get_session(
        f"local[{cpus}]",
        app="emporia-bench",
        shuffle_partitions=2 * cpus,
        conf={
            "spark.driver.memory": "16g",
            "spark.sql.files.maxPartitionBytes": "64m",
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": os.environ.get("BENCH_MIN_PART", "1m"),
        },
    )
    runs = max(1, int(os.environ.get("BENCH_RUNS", "3")))
    warm = os.path.join(os.path.dirname(base.rstrip("/")), "sf0.001")
    if not os.path.isdir(warm):
        warm = base
    for name in names:
        QUERIES[name](spark, warm).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            QUERIES[name](spark, base).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
    spark.stop()
    m = re.search(r"sf([0-9.]+)", base)
    print(
        json.dumps(
            {
                "metric": "headline_total_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(m.group(1)) if m else base,
                "cpus": cpus,
                "runs": runs,
                "warmup": os.path.basename(warm.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
