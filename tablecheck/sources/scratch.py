"""Shared scratch space for results that more than one job reads.

Everything staged here lands in the folder the cluster names in ``spark.checkpoint.dir``,
or, where that is unset, below the session's warehouse. Every executor can reach both, so
a lost executor costs a re-read and never a lost block.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
WAREHOUSE = "spark.sql.warehouse.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder the session names, else one below its warehouse."""
    configured = spark.conf.get(SETTING, None)
    if configured:
        return configured.rstrip("/")
    return f"{spark.conf.get(WAREHOUSE).rstrip('/')}/_scratch"


def session_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/tablecheck/{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, purpose: str) -> str:
    return f"{session_dir(spark)}/{purpose}-{uuid.uuid4().hex}"


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once and read it back: cuts the lineage, computes it only once."""
    path = fresh_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> bool:
    """Delete everything this application staged; call it once no result is read any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(session_dir(spark))
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.delete(path, True)
