"""Whole-table equality checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecheck.functions.names import COPIES_A, COPIES_B
from tablecheck.operators.compare import compare_multiset

# Messages of the equality check.
IS_NONE = "Dataframe cannot be None"
IS_EMPTY = "Dataframe is empty"
MISSING_COLUMN = "Missing expected column: {}"
DIFFERENT = "Data in dataframe and after_table are different."


def tables_equal(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: how many row copies each side has that the other lacks, and the verdict."""
    extra_a = F.greatest(F.col(COPIES_A) - F.col(COPIES_B), F.lit(0))
    extra_b = F.greatest(F.col(COPIES_B) - F.col(COPIES_A), F.lit(0))
    return compare_multiset(a, b).agg(
        F.coalesce(F.sum(extra_a), F.lit(0)).cast("bigint").alias("only_in_a"),
        F.coalesce(F.sum(extra_b), F.lit(0)).cast("bigint").alias("only_in_b"),
    ).withColumn("tables_equal", (F.col("only_in_a") == 0) & (F.col("only_in_b") == 0))


def assert_tables_equal(a: DataFrame | None, b: DataFrame | None) -> bool:
    """True for equal tables, ``ValueError`` otherwise."""
    if a is None or b is None:
        raise ValueError(IS_NONE)
    missing = [c for c in b.columns if c not in a.columns] + [
        c for c in a.columns if c not in b.columns
    ]
    if missing:
        raise ValueError(MISSING_COLUMN.format(missing[0]))
    if a.isEmpty():
        raise ValueError(IS_EMPTY)
    if not compare_multiset(a, b).isEmpty():
        raise ValueError(DIFFERENT)
    return True
