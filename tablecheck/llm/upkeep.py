"""Keeping the disk free while an operator works through several jobs."""

from __future__ import annotations

import gc
import time

from pyspark.sql import DataFrame, SparkSession

from tablecheck.sources.scratch import fresh_path, staged

#: How long Spark's cleaner, which works beside the jobs, is given.
CLEANING_S = 1.0


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of jobs that are over.

    It does so when the driver's garbage collector finds that nothing refers to them, which
    on a driver with little to do may be long after the disks are full.
    """
    gc.collect()
    spark._jvm.System.gc()
    time.sleep(CLEANING_S)


class Workspace:
    """A folder in the shared scratch space for what one call of an operator writes.

    ``finished`` writes the result beside it and deletes the folder: whatever reads the
    result later needs none of the steps.
    """

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark, self.purpose = spark, purpose
        self.path = fresh_path(spark, purpose)
        self._written: list[str] = []

    def staged(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.path}/{len(self._written):04d}-{name}"
        self._written.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Delete the steps of a name that all later steps have done with."""
        for path in self._written:
            if path.endswith(f"-{name}"):
                self._delete(path)

    def finished(self, df: DataFrame) -> DataFrame:
        result = staged(df, f"{self.purpose}-result")
        self._delete(self.path)
        release(self.spark)
        return result

    def _delete(self, path: str) -> None:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)
