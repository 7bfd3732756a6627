"""Run the operators on a table where one key holds a third of all rows, and print, for
every shuffled stage, the median and the largest number of records one task read.

    python scripts/skew_check.py [copies of lineitem, default 10] [sf folder]

Even stages show as a largest/median ratio near 1. Reads the session's own event log.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import tablecheck as tc  # noqa: E402

VALUES = ["l_linenumber", "l_partkey", "l_quantity", "l_returnflag"]


def versions(spark: SparkSession, sf_dir: str, copies: int) -> tuple[DataFrame, DataFrame]:
    """Two versions with key 0 on a third of the rows; a third of those are equal copies."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").repartition(32)
    lines = lines.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    hot, equal = F.col("l_orderkey") % 3 == 0, F.col("l_orderkey") % 9 == 0
    key: Column = F.when(hot, F.lit(0)).otherwise(F.col("l_orderkey") * 1000 + F.col("copy"))
    shape = lambda df: df.select(key.alias("k"), *VALUES, F.when(~equal, F.col("copy")).alias("copy"))
    changed = F.when(F.col("l_partkey") % 3 == 0, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    return shape(lines), shape(lines.where("l_partkey % 50 <> 0").withColumn("l_quantity", changed))


def with_null_keys(df: DataFrame) -> DataFrame:
    """The hot key turned to NULL, the other rows made unique."""
    single = F.concat_ws("_", "k", "l_linenumber", "l_partkey")
    keyed = df.withColumn("k", F.when(F.col("k") != 0, single))
    return keyed.where("k IS NULL").unionAll(keyed.where("k IS NOT NULL").dropDuplicates(["k"]))


def stages(log_dir: str) -> list[tuple[str, int, list[int]]]:
    names, reads = {}, defaultdict(list)
    for path in glob.glob(f"{log_dir}/**/*", recursive=True):
        if not os.path.isfile(path):
            continue
        with open(path) as lines:
            for event in map(json.loads, lines):
                if event["Event"] == "SparkListenerJobStart":
                    for stage in event["Stage IDs"]:
                        names.setdefault(stage, (event.get("Properties") or {}).get("spark.jobGroup.id"))
                elif event["Event"] == "SparkListenerTaskEnd" and event.get("Task Metrics"):
                    read = event["Task Metrics"]["Shuffle Read Metrics"]["Total Records Read"]
                    reads[event["Stage ID"]].append(read)
    return [(names[s], s, reads[s]) for s in sorted(reads) if names.get(s) and sum(reads[s])]


def main() -> None:
    copies = int(sys.argv[1]) if len(sys.argv) > 1 else 10
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="skew-log-")
    spark = (
        SparkSession.builder.master("local[8]").appName("skew-check")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "32")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", log_dir)
        .config("spark.eventLog.compress", "false")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    a, b = versions(spark, sf_dir, copies)
    runs = {
        "pair": tc.compare_by_key(a, b, ["k"], on_duplicate="pair"),
        "all columns": tc.compare_all_columns(a, b),
        "multiset": tc.compare_multiset(a, b),
        "duplicate keys": tc.duplicate_keys(a, ["k"]),
        "keyed, NULL keys": tc.compare_by_key(with_null_keys(a), with_null_keys(b), ["k"]),
        "graph nodes": tc.graph_nodes(a, "N", "k"),
        "sample": tc.sample_pair(a, b, ["k"], 100).b,
    }
    for name, frame in runs.items():
        spark.sparkContext.setJobGroup(name, name)
        frame.write.format("noop").mode("overwrite").save()
    spark.stop()
    for name, stage, reads in stages(log_dir):
        print(f"{name:18} stage {stage:3} tasks {len(reads):4} records per task: "
              f"median {statistics.median(reads):>10.0f} largest {max(reads):>10}")


if __name__ == "__main__":
    main()
