"""Benchmark the headline queries.

Runs each query once to warm up and three timed times on
``local[$BENCH_CPUS]`` against ``$BENCH_SF_DIR`` (default sf0.1), writing the
full result to the ``noop`` sink, and prints one JSON line with the median
seconds per query and their sum.  Plan construction is timed too (the
distributed rank materialises its range-partitioned input eagerly).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from medallion.catalogue import queries  # noqa: E402
from medallion.session import build_session  # noqa: E402

HEADLINE = ["standings", "team_form", "rolling_form", "top_scorers", "scorer_rank_row_number",
            "dq_matches"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2))
    qs = queries()
    out = {}
    for name in names:
        fn = qs[name]
        times = []
        for i in range(runs + 1):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            if i:
                times.append(dt)
        out[name] = round(statistics.median(times), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir.rstrip("/"))
    print(json.dumps({"metric": "headline_queries_median_sum", "value": round(sum(out.values()), 3),
                      "unit": "sec", "queries": out, "sf": float(m.group(1)) if m else None,
                      "cpus": cpus, "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
