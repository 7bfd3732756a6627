"""Time the headline queries; prints one JSON line.

Reads ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``. Each query runs once to warm up and
then ``$BENCH_RUNS`` times; the median is reported. Results go to the ``noop`` sink, so
every row and column is computed. ``--shapes`` also times an A/B run written the other
way round: one job per column over the uncached join.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import tablecheck as tc  # noqa: E402
from workload import fixtures as fx  # noqa: E402
from workload.queries import KEY, QUERIES, RUN_DATE  # noqa: E402

HEADLINE = [
    "compare_by_key", "compare_by_key_nullsafe", "compare_by_key_pair", "compare_all_columns",
    "compare_multiset", "column_mismatch_audit", "table_checksum", "table_checksum_crc32",
    "checksum_equal", "row_checksum", "sample_pair", "ab_test", "conversion_report",
    "audit_summary", "mismatch_rollup", "manifest_diff", "render_templates", "graph_nodes",
]


def session(cpus: str) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tablecheck-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def timed(action, runs: int) -> float:
    action()
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        action()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 4)


def drained(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def shapes(spark: SparkSession, sf_dir: str, runs: int) -> dict[str, float]:
    def job_per_column():
        comparison = tc.compare_by_key(*fx.orders_pair(spark, sf_dir), KEY)
        for c in fx.ORDERS:
            comparison.where(f"{c}_result = 'unmatch'").count()

    def one_aggregate():
        comparison = tc.compare_by_key(*fx.orders_pair(spark, sf_dir), KEY)
        tc.column_mismatch_audit(comparison, "a", "b", RUN_DATE).collect()

    return {"job_per_column": timed(job_per_column, runs), "one_aggregate": timed(one_aggregate, runs)}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = [n for n in sys.argv[1:] if not n.startswith("-")] or HEADLINE
    spark = session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    times = {n: timed(lambda: drained(QUERIES[n](spark, sf_dir)), runs) for n in chosen}
    report = {
        "metric": "headline queries, sum of medians", "value": round(sum(times.values()), 4),
        "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": cpus, "runs": runs,
    }
    if "--shapes" in sys.argv:
        report["shapes"] = shapes(spark, sf_dir, runs)
    spark.stop()
    print(json.dumps(report))


if __name__ == "__main__":
    main()
