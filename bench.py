"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8). Each query runs several times over the driver's tables, the
adapter to shop tables included; ``queries`` has the fastest run, ``first_run``
the first one in the session, which also compiles the generated code.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from conformance.queries import star_queries  # noqa: E402
from tidemark.session import build_session  # noqa: E402

HEADLINE = [
    "f_session_intervals",
    "f_last_session_stats",
    "f_succ_order_values",
    "f_intervals",
    "f_last3_orders_stats",
    "f_category_counts",
    "t_avg_value_excl_last",
    "t_median_interval",
    "t_ranked_session_intervals",
    "target",
    "feature_matrix",
]
RUNS = 4


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        shuffle_partitions=int(cpus),
        extra={
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = star_queries()
    best, first = {}, {}
    for name in HEADLINE:
        seconds = []
        for _ in range(RUNS):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds.append(time.perf_counter() - start)
        best[name], first[name] = round(min(seconds), 3), round(seconds[0], 3)
    spark.stop()
    result = {
        "metric": "total seconds of headline queries",
        "value": round(sum(best.values()), 3),
        "unit": "sec",
        "queries": best,
        "first_run": first,
        "sf": float(Path(sf_dir).name.removeprefix("sf")),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
