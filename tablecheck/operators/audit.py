"""Audit rows: mismatch counts of a comparison in the shape of the audit table."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecheck.functions.flags import unmatched_counters, unmatched_totals
from tablecheck.functions.names import SUFFIX_RESULT, VERDICT, compared_columns
from tablecheck.sources.sinks import write_jdbc
from tablecheck.sources.tables import append_table, ensure_table

# Audit columns, the default test name and the whole-row column name.
AUDIT_SCHEMA = T.StructType([
    T.StructField("test_name", T.StringType()),
    T.StructField("table_a", T.StringType()),
    T.StructField("table_b", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("schema_mismatch", T.BooleanType()),
    T.StructField("data_mismatch", T.BooleanType()),
    T.StructField("mismatch_count", T.LongType()),
    T.StructField("validation_errors", T.StringType()),
    T.StructField("run_date", T.TimestampType()),
    T.StructField("run_label", T.StringType()),
])
TEST_NAME = "ABTest"
ALL_COLUMNS = "ALL"
OLD_NAMES = {
    "table_before": "table_a",
    "table_after": "table_b",
    "story_name": "run_label",
    "branch_name": "run_label",
}

_COUNTED = "column_name string, schema_mismatch boolean, mismatch_count bigint, validation_errors string"


def column_mismatch_audit(
    comparison: DataFrame,
    name_a: str,
    name_b: str,
    run_date: datetime | str | Column | None = None,
    run_label: str | None = None,
    schema_differences: Mapping[str, str] | None = None,
    test_name: str = TEST_NAME,
    totals: DataFrame | None = None,
) -> DataFrame:
    """One audit row per column, from a single aggregate over the comparison, or from
    ``totals`` that were counted before.

    Columns named in ``schema_differences`` are marked; those that could not be compared
    get a row without a count that says why.
    """
    differences = dict(schema_differences or {})
    compared = compared_columns(comparison)
    if totals is None:
        totals = unmatched_totals(comparison, flags_counted(comparison))
    differs = F.col("column_name").isin(list(differences)) if differences else F.lit(False)
    counted = totals.select(
        "column_name", differs.alias("schema_mismatch"), "mismatch_count",
        F.lit(None).cast("string").alias("validation_errors"),
    )
    skipped = [
        (c, True, None, f"column not compared: {why}") for c, why in differences.items() if c not in compared
    ]
    if skipped:
        counted = counted.unionAll(comparison.sparkSession.createDataFrame(skipped, _COUNTED))
    return _audit_rows(counted, name_a, name_b, run_date, run_label, test_name)


def table_mismatch_audit(
    comparison: DataFrame,
    name_a: str,
    name_b: str,
    run_date: datetime | str | Column | None = None,
    run_label: str | None = None,
    schema_differences: Mapping[str, str] | None = None,
    test_name: str = TEST_NAME,
    totals: DataFrame | None = None,
) -> DataFrame:
    """One ``ALL`` audit row: how many compared rows differ in any column."""
    if totals is None:
        totals = unmatched_totals(comparison, flags_counted(comparison, per_column=False))
    counted = totals.select(
        "column_name", F.lit(bool(schema_differences)).alias("schema_mismatch"), "mismatch_count",
        F.lit(None).cast("string").alias("validation_errors"),
    )
    return _audit_rows(counted, name_a, name_b, run_date, run_label, test_name)


def audit_records(
    comparison: DataFrame,
    name_a: str,
    name_b: str,
    run_date: datetime | str | Column | None = None,
    run_label: str | None = None,
    per_column: bool = True,
    schema_differences: Mapping[str, str] | None = None,
    test_name: str = TEST_NAME,
    totals: DataFrame | None = None,
) -> DataFrame:
    make = column_mismatch_audit if per_column else table_mismatch_audit
    return make(comparison, name_a, name_b, run_date, run_label, schema_differences, test_name, totals)


def flags_counted(comparison: DataFrame, per_column: bool = True) -> dict[str, str]:
    """The flag columns behind the audit rows, by the name each row has."""
    return {c: c + SUFFIX_RESULT for c in compared_columns(comparison)} if per_column else {ALL_COLUMNS: VERDICT}


class WatchedComparison:
    """Counts mismatches while something else reads the comparison.

    ``rows`` is the comparison; once an action has read it to the end, ``totals`` has the
    counts, and the rows need not be read again for them.
    """

    def __init__(self, comparison: DataFrame, per_column: bool = True):
        self._spark = comparison.sparkSession
        self._flags = flags_counted(comparison, per_column)
        self._seen = Observation()
        counts = unmatched_counters(comparison, self._flags.values())
        self.rows = comparison.observe(self._seen, *[n.alias(f"n{i}") for i, n in enumerate(counts)])

    def totals(self) -> DataFrame:
        seen = self._seen.get
        counted = [(name, seen[f"n{i}"]) for i, name in enumerate(self._flags)]
        return self._spark.createDataFrame(counted, "column_name string, mismatch_count bigint")


def audit_append(records: DataFrame, table: str, run_label: str | None = None, fmt: str = "parquet") -> None:
    """Append audit rows, creating the table first when it does not exist."""
    shaped = as_audit(records)
    if run_label is not None:
        shaped = shaped.withColumn("run_label", F.lit(run_label))
    ensure_table(records.sparkSession, table, AUDIT_SCHEMA, fmt)
    append_table(shaped, table, fmt)


def audit_jdbc_append(
    records: DataFrame, url: str, table: str, run_label: str | None = None,
    properties: Mapping[str, str] | None = None,
) -> None:
    """Append audit rows to a relational table."""
    shaped = as_audit(records)
    if run_label is not None:
        shaped = shaped.withColumn("run_label", F.lit(run_label))
    write_jdbc(shaped, url, table, properties)


def as_audit(records: DataFrame) -> DataFrame:
    """Bring audit rows, older column names included, to the audit schema."""
    present: dict[str, str] = {}
    for c in records.columns:
        name = OLD_NAMES.get(c, c)
        if name in present:
            raise ValueError(f"{present[name]} and {c} are both audit column {name}")
        present[name] = c
    unknown = sorted(set(present) - set(AUDIT_SCHEMA.names))
    if unknown:
        raise ValueError(f"not audit columns: {', '.join(unknown)}")
    return records.select(*[
        (F.col(present[f.name]) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in AUDIT_SCHEMA.fields
    ])


def empty_audit(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], AUDIT_SCHEMA)


def run_date_column(run_date: datetime | str | Column | None) -> Column:
    if run_date is None:
        return F.current_timestamp()
    if isinstance(run_date, Column):
        return run_date.cast("timestamp")
    if isinstance(run_date, datetime) and run_date.tzinfo is None:
        run_date = run_date.isoformat(sep=" ")  # wall clock of the session time zone
    return F.lit(run_date).cast("timestamp")


def _audit_rows(counted, name_a, name_b, run_date, run_label, test_name) -> DataFrame:
    return as_audit(counted.select(
        "*",
        (F.col("mismatch_count") > 0).alias("data_mismatch"),
        F.lit(test_name).alias("test_name"),
        F.lit(name_a).alias("table_a"),
        F.lit(name_b).alias("table_b"),
        run_date_column(run_date).alias("run_date"),
        F.lit(run_label).alias("run_label"),
    ))
