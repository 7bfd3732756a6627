"""Named tables: append, replace, create, drop, locate.

The table provider is an argument (``fmt``), Parquet by default. Errors are raised, never
logged away.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablecheck.functions.names import last_part

# Providers whose overwrite is atomic, so no staging table is needed.
_ATOMIC = {"delta", "iceberg"}


def sql_name(table: str) -> str:
    """Quote a dotted table name part by part, for DDL that takes no parameter marker."""
    return ".".join("`" + p.strip("`").replace("`", "``") + "`" for p in table.split("."))


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:t)", args={"t": sql_name(table)})


def ensure_table(spark: SparkSession, table: str, schema: StructType, fmt: str = "parquet") -> None:
    """Create an empty table when there is none; an existing one is left alone."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {sql_name(table)} ({schema.toDDL()}) USING {fmt}")


def append_table(df: DataFrame, table: str, fmt: str = "parquet") -> None:
    df.write.format(fmt).mode("append").saveAsTable(table)


def replace_table(
    df: DataFrame,
    table: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    bucket_by: tuple[int, Sequence[str]] | None = None,
) -> int:
    """Write ``df`` as ``table``, replacing it, and return the number of rows written.

    The rows go to a staging table first and the name is switched at the end, so a
    failed job leaves the old table in place and ``df`` may read the table it replaces.
    ``bucket_by=(n, keys)`` lays the rows out so that later joins on ``keys`` need no
    shuffle.
    """
    spark = df.sparkSession
    rows = Observation()
    writer = df.observe(rows, F.count(F.lit(1)).alias("n")).write.format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        buckets, cols = bucket_by
        writer = writer.bucketBy(buckets, *cols).sortBy(*cols)
    if fmt in _ATOMIC:
        writer.mode("overwrite").saveAsTable(table)
    else:
        prefix, name = last_part(table)
        staging = f"{prefix}{name}_new_{uuid.uuid4().hex[:12]}"
        writer.saveAsTable(staging)
        _swap(spark, staging, table)
        if partition_by:  # a catalog may still list the partitions under the staging name
            spark.sql(f"MSCK REPAIR TABLE {sql_name(table)} SYNC PARTITIONS")
    return int(rows.get["n"])


def _rename(spark: SparkSession, old: str, new: str) -> None:
    spark.sql(f"ALTER TABLE {sql_name(old)} RENAME TO {sql_name(new)}")


def _swap(spark: SparkSession, staging: str, table: str) -> None:
    """Give ``staging`` the name of ``table``; the old table goes only once that is done."""
    if not spark.catalog.tableExists(table):
        _rename(spark, staging, table)
        return
    prefix, name = last_part(table)
    aside = f"{prefix}{name}_old_{uuid.uuid4().hex[:12]}"
    _rename(spark, table, aside)
    try:
        _rename(spark, staging, table)
    except Exception:
        _rename(spark, aside, table)
        raise
    drop_table(spark, aside)


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def table_location(spark: SparkSession, table: str) -> str:
    described = spark.sql("DESCRIBE TABLE EXTENDED IDENTIFIER(:t)", args={"t": sql_name(table)})
    row = described.where("col_name = 'Location'").select("data_type").first()
    if row is None:
        raise ValueError(f"{table} has no storage location (is it a view?)")
    return row[0]
