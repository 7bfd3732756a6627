"""Reports on comparisons and on the audit table, as DataFrames any BI tool can plot."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecheck.functions.flags import unmatched_totals
from tablecheck.functions.names import SUFFIX_RESULT, compared_columns
from tablecheck.sources.scratch import staged

# Workspace patterns in order of precedence, and the clean-run message.
WORKSPACES = (("%dev%", "Dev"), ("%test%", "Test"), ("%prod%", "Prod"))
UNKNOWN_WORKSPACE = "Unknown"
NO_ERRORS = "No errors"
PAIR_LABEL = " / "

_GROUP = ["test_name", "table_a", "table_b", "column_name"]


def unmatched_counts(comparison: DataFrame) -> DataFrame:
    """``column_name, unmatched_count`` for every compared column, largest first."""
    totals = unmatched_totals(comparison, {c: c + SUFFIX_RESULT for c in compared_columns(comparison)})
    counts = totals.withColumnRenamed("mismatch_count", "unmatched_count")
    return counts.orderBy(F.desc("unmatched_count"), "column_name")


def audit_dashboard(audit: DataFrame) -> DataFrame:
    """One dashboard row per audit row."""
    name, label = WORKSPACES[0]
    workspace = F.when(F.col("test_name").like(name), label)
    for name, label in WORKSPACES[1:]:
        workspace = workspace.when(F.col("test_name").like(name), label)
    return audit.select(
        workspace.otherwise(UNKNOWN_WORKSPACE).alias("Workspace"),
        F.col("table_a").alias("Base_Table"),
        F.col("table_b").alias("Test_Table"),
        "schema_mismatch",
        F.col("mismatch_count").alias("actual_mismatch"),
        F.when(F.col("mismatch_count") == 0, "No").otherwise("Yes").alias("Table_mismatch"),
    )


def _is_mismatch(null_is_clean: bool) -> Column:
    flagged = [
        F.coalesce(F.col("schema_mismatch"), F.lit(False)),
        F.coalesce(F.col("data_mismatch"), F.lit(False)),
        F.coalesce(F.col("mismatch_count") > 0, F.lit(False)),
    ]
    errors = F.col("validation_errors")
    faulty = F.coalesce(errors, F.lit(NO_ERRORS)) if null_is_clean else errors
    return flagged[0] | flagged[1] | flagged[2] | ~faulty.eqNullSafe(F.lit(NO_ERRORS))


def audit_mismatches(audit: DataFrame, null_is_clean: bool = False) -> DataFrame:
    """Audit rows that report a mismatch. A NULL ``validation_errors`` counts as one
    unless ``null_is_clean``; rows without a test name are left out."""
    return audit.where(F.col("test_name").isNotNull() & _is_mismatch(null_is_clean))


def mismatch_rollup(audit: DataFrame) -> DataFrame:
    """First pair of tables of each test with schema mismatches, and with data mismatches.

    First by ``run_date, table_a, table_b``; NULL names are skipped, as is a test with
    no mismatch of the kind.
    """
    order = F.struct("run_date", "table_a", "table_b")
    first = lambda c, hit: F.min_by(F.when(hit, F.col(c)), F.when(hit & F.col(c).isNotNull(), order))
    kinds = {"schema": F.col("schema_mismatch"), "data": F.col("data_mismatch")}
    summed = audit.where("test_name IS NOT NULL AND (schema_mismatch OR data_mismatch)").groupBy("test_name").agg(*[
        F.struct(
            F.lit(kind).alias("kind"),
            F.count_if(hit).alias("hits"),
            first("table_a", hit).alias("table_a"),
            first("table_b", hit).alias("table_b"),
        ).alias(kind)
        for kind, hit in kinds.items()
    ])
    opened = summed.select("test_name", F.explode(F.array(*kinds)).alias("entry"))
    return opened.where("entry.hits > 0").select(
        "entry.kind",
        "test_name",
        "entry.table_a",
        "entry.table_b",
        F.concat("entry.table_a", F.lit(PAIR_LABEL), "entry.table_b").alias("tables"),
    )


def _drill_down_text() -> Column:
    """Fixed format: the statement that looks into one column of a table pair."""
    a, b, c = F.col("table_a"), F.col("table_b"), F.col("column_name")
    inner = F.concat(F.lit("SELECT "), c, F.lit(" FROM "), b, F.lit(" WHERE "), c, F.lit(" IS NULL"))
    return F.concat(
        F.lit("SELECT * FROM "), a, F.lit(" WHERE "), c, F.lit(" IS NULL OR "),
        c, F.lit(" IN ("), inner, F.lit(")"),
    )


def audit_summary(
    audit: DataFrame, expected_columns: DataFrame, run_date: datetime | str | Column | None = None
) -> DataFrame:
    """Per test, pair and column: audit rows, mismatch flags, and a drill-down statement.

    ``expected_columns(column_name)`` lists the columns that should exist; any other is a
    schema mismatch. The drill-down text depends only on the group, so the one aggregate
    that counts also makes it; the join sees a row per group, not per audit row.
    """
    complete = F.lit(True)
    for name in _GROUP:
        complete = complete & F.col(name).isNotNull()
    wanted = complete & (F.col("schema_mismatch") | F.col("data_mismatch"))
    groups = audit.groupBy(*_GROUP).agg(
        F.count(F.lit(1)).alias("mismatch_count"),
        (F.count_if(F.col("data_mismatch")) > 0).alias("data_mismatch"),
        (F.count_if(wanted) > 0).alias("explained"),
    )
    known = expected_columns.select(F.col("column_name").alias("known")).distinct()
    known = staged(known, "expected-columns")  # its size is known to the join
    when = F.current_date() if run_date is None else F.lit(run_date).cast("date")
    return (
        groups.join(known, F.col("column_name") == F.col("known"), "left")
        .select(
            *_GROUP,
            (F.col("known").isNull() & F.col("column_name").isNotNull()).alias("schema_mismatch"),
            "data_mismatch",
            "mismatch_count",
            when.alias("run_date"),
            F.when(F.col("explained"), _drill_down_text()).alias("drill_down_query"),
        )
        .orderBy(*_GROUP)
    )
