"""Time the queries: one JSON line. BENCH_SF_DIR, BENCH_CPUS and BENCH_RUNS set data, cores and repeats."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from warcaudit.plans import registry

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))


def session() -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{CPUS}]").appName("warcaudit bench")
             .config("spark.sql.shuffle.partitions", CPUS).config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "12g")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(spark: SparkSession, query) -> float:
    """Best of the runs; the whole result is computed and thrown away."""
    best = None
    for _ in range(RUNS):
        begin = time.perf_counter()
        query(spark, FOLDER).write.format("noop").mode("overwrite").save()
        spent = time.perf_counter() - begin
        best = spent if best is None else min(best, spent)
    return round(best, 3)


def main() -> None:
    spark = session()
    wanted = sys.argv[1:] or list(registry.all_queries())
    times = {name: timed(spark, registry.all_queries()[name]) for name in wanted}
    print(json.dumps({"metric": "total time of all queries", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
