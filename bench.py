"""Time the headline reports and print one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the local threads,
BENCH_RUNS the timed runs of each report, of which the best counts, BENCH_QUERIES a subset.
"""

from __future__ import annotations

import json
import os
import sys
import time

from burgage.plans.catalog import QUERIES
from burgage.session import get_session

# Throughput collector; room for the compiled code of many different reports; and compilation of
# the long methods that Spark generates for wide projections, which the JVM leaves out by default.
JVM_OPTIONS = ("-XX:+UseParallelGC -XX:ReservedCodeCacheSize=512m "
               "-XX:-DontCompileHugeMethods")


def run(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    chosen = os.environ.get("BENCH_QUERIES", "").split() or list(QUERIES)
    spark = get_session(
        "burgage-bench", master=f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="12g", spark__driver__extraJavaOptions=JVM_OPTIONS,
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    try:
        QUERIES["permits_trend"](spark, sf_dir).count()  # start-up is not part of any report
        for name in chosen:
            times[name] = round(min(run(QUERIES[name], spark, sf_dir) for _ in range(runs)), 3)
            print(f"{name} {times[name]}", file=sys.stderr)
    finally:
        spark.stop()
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
