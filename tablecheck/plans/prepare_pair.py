"""Make two tables comparable: re-clone when the files differ, then sample both."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import SparkSession

from tablecheck.functions.names import last_part
from tablecheck.operators.clone import clone_full
from tablecheck.operators.manifest import files_equal
from tablecheck.operators.sample import lowest_rows, normalize_columns, rows_of_keys, sample_keys
from tablecheck.sources.tables import drop_table, replace_table, table_location

# Postfix of the sampled tables and prefix of the key table.
SAMPLE_POSTFIX = "_temp"
KEY_PREFIX = "key_"


class PreparedPair(NamedTuple):
    main: str
    clone: str
    recreated: bool


def data_files_equal(spark: SparkSession, table_a: str, table_b: str) -> bool:
    """Compare number, total size and partitioning of the files of two named tables."""
    places = [table_location(spark, t) for t in (table_a, table_b)]
    return files_equal(spark, *places).first()["files_equal"]


def prepare_pair(
    spark: SparkSession,
    main: str,
    clone: str,
    keys: Sequence[str],
    limit: int,
    recreate: bool = True,
    row_limit: int | None = None,
    fmt: str = "parquet",
    bucket_by: tuple[int, Sequence[str]] | None = None,
) -> PreparedPair:
    """Write ``<main>_temp`` and ``<clone>_temp`` holding the same sampled keys.

    The keys are kept in a ``key_`` table while both samples are cut, and dropped after.
    ``bucket_by`` lays both samples out for a shuffle-free comparison on the keys.
    """
    recreated = False
    if recreate and not (spark.catalog.tableExists(clone) and data_files_equal(spark, main, clone)):
        clone_full(spark, main, clone, fmt)
        recreated = True
    prefix, name = last_part(main)
    key_table = f"{prefix}{KEY_PREFIX}{name}"
    replace_table(sample_keys(normalize_columns(spark.table(main)), list(keys), limit), key_table, fmt)
    sample = spark.table(key_table)
    for table in (main, clone):
        cut = rows_of_keys(normalize_columns(spark.table(table)), sample)
        if row_limit is not None:
            cut = lowest_rows(cut, list(keys), row_limit)
        replace_table(cut, table + SAMPLE_POSTFIX, fmt, bucket_by=bucket_by)
    drop_table(spark, key_table)
    return PreparedPair(main + SAMPLE_POSTFIX, clone + SAMPLE_POSTFIX, recreated)
