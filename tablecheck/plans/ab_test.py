"""The A/B run: schema diff, comparison, result table, audit rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession

from tablecheck.functions.names import aligned
from tablecheck.operators.audit import TEST_NAME, WatchedComparison, audit_append, audit_records
from tablecheck.operators.compare import compare_all_columns, compare_by_key
from tablecheck.operators.schema import differing_columns
from tablecheck.sources.tables import replace_table


@dataclass(frozen=True)
class ABTest:
    """What to compare and where to put it.

    ``keys`` empty compares on all columns. ``table_b`` defaults to ``table_a`` plus
    ``post_fix``.
    """

    table_a: str
    result_table: str
    audit_table: str
    post_fix: str = "_b"
    table_b: str | None = None
    keys: Sequence[str] = ()
    null_equal: bool = False
    on_duplicate: str = "error"
    per_column: bool = True
    run_label: str | None = None
    test_name: str = TEST_NAME
    fmt: str = "parquet"

    @property
    def other_table(self) -> str:
        return self.table_b or self.table_a + self.post_fix


def result_overwrite(comparison: DataFrame, table: str, fmt: str = "parquet") -> DataFrame:
    """Write a comparison as ``table``, replacing it, and return the written table."""
    replace_table(comparison, table, fmt)
    return comparison.sparkSession.table(table)


def run_ab_test(
    spark: SparkSession, test: ABTest, run_date: datetime | str | Column | None = None
) -> DataFrame:
    """Run one test and return the audit rows it appended.

    The join runs once, while the result table is written; the counts are observed on the
    way, so the written table is not read.
    """
    a = spark.table(test.table_a)
    b = aligned(a, spark.table(test.other_table))
    differences = differing_columns(a.schema, b.schema)
    if test.keys:
        comparison = compare_by_key(a, b, list(test.keys), test.null_equal, test.on_duplicate)
    else:
        comparison = compare_all_columns(a, b)
    watched = WatchedComparison(comparison, test.per_column)
    replace_table(watched.rows, test.result_table, test.fmt)
    records = audit_records(
        comparison, test.table_a, test.other_table, run_date, test.run_label,
        test.per_column, differences, test.test_name, watched.totals(),
    )
    # A handful of rows: fixed on the driver so that the appended and returned rows agree.
    records = spark.createDataFrame(records.collect(), records.schema)
    audit_append(records.coalesce(1), test.audit_table, fmt=test.fmt)
    return records
