"""Data-file listing of a folder: one row per file, contents not read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def data_files(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """``(file_path, size, partition_columns)`` for every data file under ``path``.

    Only the path and length columns of the listing are read. Partition columns are
    the ``name=value`` folders between ``path`` and the file.
    """
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(F.col("path").alias("file_path"), F.col("length").alias("size"))
    )
    root = F.lit(path.split(":", 1)[-1].strip("/"))  # listed paths may spell the scheme differently
    below = F.substring(
        "file_path", F.instr("file_path", root) + F.length(root), F.length("file_path")
    )
    folders = F.regexp_extract_all(below, F.lit(r"/([^/=]+)=[^/]*(?=/)"), 1)
    return listed.withColumn("partition_columns", folders)
