"""Physical comparison: files named by transaction logs, and data-file statistics.

``log`` arguments are file actions as ``tablecheck.sources.txlog`` returns them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecheck.operators.fingerprint import file_checksums
from tablecheck.sources.listing import data_files


def manifest_added(log: DataFrame) -> DataFrame:
    """Every file the log ever added."""
    return log.where("is_add").select("file_path").distinct()


def manifest_live(log: DataFrame) -> DataFrame:
    """Files of the current table version: those whose last action is an add.

    Replay is an aggregate per path, combined before the shuffle. Within one version an
    add outranks the removal of the same path, and the larger of two adds wins.
    """
    last = F.max_by(F.struct("is_add", "size"), F.struct("version", "is_add", "size"))
    replayed = log.groupBy("file_path").agg(last.alias("last"))
    return replayed.where("last.is_add").select("file_path", F.col("last.size").alias("size"))


def manifest_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """File paths found in one manifest only, with the ``side`` that has them."""
    marked = a.select("file_path", F.lit(True).alias("in_a")).unionByName(
        b.select("file_path", F.lit(False).alias("in_a"))
    )
    sides = marked.groupBy("file_path").agg(
        F.bool_or("in_a").alias("in_a"), F.bool_or(~F.col("in_a")).alias("in_b")
    )
    side = F.when(F.col("in_a"), F.lit("a")).otherwise(F.lit("b"))
    return sides.where("in_a <> in_b").select("file_path", side.alias("side"))


def file_stats(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """One row: number of data files, their total size, and the partition columns."""
    return data_files(spark, path, pattern).agg(
        F.count(F.lit(1)).alias("num_files"),
        F.coalesce(F.sum("size"), F.lit(0)).cast("bigint").alias("size_in_bytes"),
        F.coalesce(F.max("partition_columns"), F.array().cast("array<string>")).alias("partition_columns"),
    )


def files_equal(spark: SparkSession, path_a: str, path_b: str, pattern: str = "*.parquet") -> DataFrame:
    """One row saying whether the file statistics of two tables agree.

    A cheap hint for deciding on a re-clone: equal statistics do not prove equal data;
    ``file_contents_equal`` looks into the files.
    """
    both = file_stats(spark, path_a, pattern).withColumn("side", F.lit("a")).unionByName(
        file_stats(spark, path_b, pattern).withColumn("side", F.lit("b"))
    )
    stats = F.struct("partition_columns", "num_files", "size_in_bytes")
    sides = both.agg(
        F.max(F.when(F.col("side") == "a", stats)).alias("stats_a"),
        F.max(F.when(F.col("side") == "b", stats)).alias("stats_b"),
    )
    return sides.withColumn("files_equal", F.col("stats_a") == F.col("stats_b"))


def file_contents_equal(
    spark: SparkSession, path_a: str, path_b: str, algo: str = "md5", fmt: str = "parquet"
) -> DataFrame:
    """One row: files with rows on each side, those whose contents the other side lacks, and
    whether there are none.

    Files are told by their rows alone, in any order: number of rows and checksum, as
    multisets, so names do not count. Tables cut into other files differ here even if they
    hold the same rows; ``checksum_equal`` compares those.
    """
    marked = [
        file_checksums(spark, path, algo, fmt=fmt).select("row_count", "checksum", F.lit(side).alias("side"))
        for path, side in ((path_a, 1), (path_b, -1))
    ]
    same = marked[0].unionAll(marked[1]).groupBy("row_count", "checksum").agg(
        F.count_if(F.col("side") > 0).alias("in_a"), F.count_if(F.col("side") < 0).alias("in_b")
    )
    zero = F.lit(0).cast("bigint")
    more = lambda x, y: F.coalesce(F.sum(F.greatest(F.col(x) - F.col(y), zero)), zero)
    totals = same.agg(
        F.coalesce(F.sum("in_a"), zero).alias("files_a"), F.coalesce(F.sum("in_b"), zero).alias("files_b"),
        more("in_a", "in_b").alias("only_in_a"), more("in_b", "in_a").alias("only_in_b"),
    )
    return totals.withColumn("contents_equal", (F.col("only_in_a") == 0) & (F.col("only_in_b") == 0))
