"""Benchmark the headline queries.

Runs every query registered with ``bench=True`` on ``$BENCH_SF_DIR``
(default /root/testdata/sf0.1) with ``local[$BENCH_CPUS]``; each query is
executed in full through the ``noop`` sink, ``$BENCH_RUNS`` times (median
reported, default 3) after one untimed warm-up pass.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from crewspark.plans import all_queries  # noqa: E402
from crewspark.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    spark = local_session(cpus, app="crewspark-bench", **{"spark.sql.shuffle.partitions": str(max(8, int(cpus) * 2))})
    queries = {n: q for n, q in all_queries().items() if (q.bench and not only) or n in only}

    def run_once(q) -> float:
        t0 = time.perf_counter()
        q.spark_df(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    timings: dict[str, float] = {}
    for name, q in queries.items():
        run_once(q)  # warm-up: JIT, Python workers, file listing caches
        samples = [run_once(q) for _ in range(runs)]
        timings[name] = round(statistics.median(samples), 3)
        print(f"# {name}: {timings[name]}s (runs {[round(s, 2) for s in samples]})", file=sys.stderr)

    print(json.dumps({"metric": "total_median_query_time", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": timings, "sf": sf, "cpus": int(cpus), "runs": runs}))


if __name__ == "__main__":
    main()
