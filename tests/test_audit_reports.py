"""Audit rows, the audit table, reports, and the whole A/B run."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

import tablecheck as tc
from tablecheck.operators.audit import AUDIT_SCHEMA, empty_audit
from tablecheck.operators.schema import differing_columns
from workload import fixtures as fx

SF_DIR = "/root/testdata/sf0.01"
RUN = datetime(2024, 1, 1, 12, 0, 0)


def dicts(frame):
    return [r.asDict(recursive=True) for r in frame.collect()]


def audit_frame(spark, *rows):
    names = AUDIT_SCHEMA.names
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], AUDIT_SCHEMA)


def five_mismatches(spark):
    """Region has five rows; none of them is in B."""
    region = spark.read.parquet(f"{SF_DIR}/region.parquet")
    return tc.compare_by_key(region, region.limit(0), ["r_regionkey"])


def test_record_of_every_column(spark):
    moment = datetime(2031, 5, 6, 7, 8, 9)
    records = dicts(tc.audit_records(five_mismatches(spark), "regions", "regions_new", moment))
    assert [r.pop("column_name") for r in records] == ["r_regionkey", "r_name"]
    assert all(r == {
        "test_name": "ABTest", "table_a": "regions", "table_b": "regions_new", "schema_mismatch": False,
        "data_mismatch": True, "mismatch_count": 5, "validation_errors": None, "run_date": moment, "run_label": None,
    } for r in records)


def test_two_columns_for_one_audit_column(spark):
    row = spark.createDataFrame([("x", "y")], "story_name string, run_label string")
    with pytest.raises(ValueError, match="story_name and run_label are both audit column run_label"):
        tc.as_audit(row)


def test_summary_record(spark):
    [row] = dicts(tc.audit_records(five_mismatches(spark), "a", "b", RUN, "label", per_column=False))
    assert (row["column_name"], row["mismatch_count"], row["run_label"]) == ("ALL", 5, "label")
    clean = five_mismatches(spark).where("r_regionkey_a < 0")
    [row] = dicts(tc.audit_records(clean, "a", "b", RUN, per_column=False))
    assert (row["data_mismatch"], row["mismatch_count"]) == (False, 0)


@pytest.mark.parametrize("form", [lambda: RUN, lambda: "2024-01-01 12:00:00", lambda: F.lit("2024-01-01 12:00:00"), lambda: None])
def test_run_date_forms(spark, form):
    run_date = form()
    [row] = dicts(tc.audit_records(five_mismatches(spark), "a", "b", run_date, per_column=False))
    assert isinstance(row["run_date"], datetime)
    assert run_date is None or row["run_date"] == RUN


def test_schema_differences_reach_the_audit(spark):
    a = spark.createDataFrame([(1, "x", 5)], "k int, t string, only int")
    b = spark.createDataFrame([(1, 7, 2)], "k bigint, t int, other int")
    differences = differing_columns(a.schema, b.schema)
    rows = {r["column_name"]: r for r in dicts(
        tc.audit_records(tc.compare_by_key(a, b, ["k"]), "a", "b", RUN, schema_differences=differences))}
    assert rows["k"]["schema_mismatch"] and rows["k"]["mismatch_count"] == 0
    assert rows["t"]["mismatch_count"] is None
    assert rows["t"]["validation_errors"] == "column not compared: type"
    assert rows["only"]["validation_errors"] == "column not compared: only_a"
    assert rows["other"]["validation_errors"] == "column not compared: only_b"


def test_counts_weigh_copies(spark):
    a = spark.createDataFrame([(1, "x")] * 5 + [(2, "y")] * 3, "k int, v string")
    b = spark.createDataFrame([(1, "x")] * 2 + [(2, "z")], "k int, v string")
    paired = tc.compare_by_key(a, b, ["k"], on_duplicate="pair")
    assert {r["column_name"]: r["mismatch_count"] for r in dicts(tc.audit_records(paired, "a", "b"))} == {"k": 5, "v": 6}
    by_all = tc.compare_all_columns(a, b)
    [total] = dicts(tc.audit_records(by_all, "a", "b", per_column=False))
    assert total["mismatch_count"] == 4  # three (2, y) and one (2, z); the copies of (1, x) all join


def test_append_creates_then_adds(spark, schema):
    table = f"{schema}.audit"
    records = tc.audit_records(five_mismatches(spark), "a", "b", RUN)
    tc.audit_append(records, table, run_label="first")
    tc.audit_append(records, table, run_label="second")
    stored = spark.table(table)
    assert stored.schema.names == AUDIT_SCHEMA.names
    assert stored.groupBy("run_label").count().orderBy("run_label").collect() == [("first", 2), ("second", 2)]
    assert dict(stored.dtypes)["mismatch_count"] == "bigint"


def test_append_takes_older_audit_rows(spark, schema):
    old = spark.createDataFrame(
        [("T", "x", "y", "c", False, True, 4, None, "story")],
        "test_name string, table_before string, table_after string, column_name string, schema_mismatch boolean, "
        "data_mismatch boolean, mismatch_count int, validation_errors string, story_name string",
    )
    tc.audit_append(old, f"{schema}.audit")
    [row] = dicts(spark.table(f"{schema}.audit"))
    assert (row["table_a"], row["table_b"], row["run_label"], row["run_date"]) == ("x", "y", "story", None)
    with pytest.raises(ValueError, match="not audit columns: zzz"):
        tc.as_audit(old.withColumn("zzz", F.lit(1)))


def test_failed_append_raises(spark, schema):
    spark.sql(f"CREATE TABLE {schema}.audit (something INT) USING parquet")
    with pytest.raises(Exception):
        tc.audit_append(tc.audit_records(five_mismatches(spark), "a", "b", RUN), f"{schema}.audit")
    assert spark.table(f"{schema}.audit").columns == ["something"]


def test_run_by_key(spark, schema):
    a, b = fx.orders_pair(spark, SF_DIR)
    a.write.saveAsTable(f"{schema}.orders")
    b.write.saveAsTable(f"{schema}.orders_b")
    test = tc.ABTest(f"{schema}.orders", f"{schema}.result", f"{schema}.audit", keys=["o_orderkey"], run_label="s")
    returned = tc.run_ab_test(spark, test, RUN)
    assert sorted(returned.collect()) == sorted(spark.table(f"{schema}.audit").collect())
    assert spark.table(f"{schema}.result").count() == 15146
    tc.run_ab_test(spark, test, RUN)  # a second run replaces the result and adds audit rows
    assert spark.table(f"{schema}.result").count() == 15146
    assert spark.table(f"{schema}.audit").count() == 12


def test_counts_read_only_the_flags_of_the_written_result(spark, schema):
    written = tc.result_overwrite(tc.compare_by_key(*fx.orders_pair(spark, SF_DIR), ["o_orderkey"]), f"{schema}.r")
    plan = tc.column_mismatch_audit(written, "a", "b", RUN)._jdf.queryExecution().executedPlan().toString()
    schema_read = plan.split("ReadSchema: ")[1].splitlines()[0]
    assert "_result" in schema_read and "_a:" not in schema_read and "_b:" not in schema_read


def test_run_on_all_columns(spark, schema):
    a, b = fx.orders_pair(spark, SF_DIR)
    a.write.saveAsTable(f"{schema}.x")
    b.write.saveAsTable(f"{schema}.y")
    test = tc.ABTest(f"{schema}.x", f"{schema}.result", f"{schema}.audit", table_b=f"{schema}.y", per_column=False)
    [row] = dicts(tc.run_ab_test(spark, test, RUN))
    assert (row["table_b"], row["column_name"], row["mismatch_count"]) == (f"{schema}.y", "ALL", 1651)


def test_run_with_repeated_keys_in_pairs(spark, schema):
    spark.createDataFrame([(1, "x")] * 3 + [(2, None)], "k int, v string").write.saveAsTable(f"{schema}.t")
    spark.createDataFrame([(1, "x")] * 2 + [(1, "y"), (2, None)], "k int, v string").write.saveAsTable(f"{schema}.t_b")
    for null_equal, expected in ((False, {"k": 0, "v": 2}), (True, {"k": 0, "v": 1})):
        test = tc.ABTest(f"{schema}.t", f"{schema}.result", f"{schema}.audit", keys=["k"], null_equal=null_equal,
                         on_duplicate="pair", test_name="dev_pairs")
        rows = dicts(tc.run_ab_test(spark, test, RUN))
        assert {r["column_name"]: r["mismatch_count"] for r in rows} == expected
    shown = tc.audit_dashboard(spark.table(f"{schema}.audit"))
    assert {r["Workspace"] for r in dicts(shown)} == {"Dev"}


def test_run_on_a_missing_table_raises(spark, schema):
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        tc.run_ab_test(spark, tc.ABTest(f"{schema}.no", f"{schema}.r", f"{schema}.a"))
    assert not spark.catalog.tableExists(f"{schema}.a")


def test_run_with_a_repeated_key_leaves_the_old_result(spark, schema):
    rows = spark.createDataFrame([(1, "x")], "k int, v string")
    rows.write.saveAsTable(f"{schema}.t")
    rows.write.saveAsTable(f"{schema}.t_b")
    test = tc.ABTest(f"{schema}.t", f"{schema}.result", f"{schema}.audit", keys=["k"])
    tc.run_ab_test(spark, test, RUN)
    rows.write.mode("append").saveAsTable(f"{schema}.t")
    with pytest.raises(Exception, match="duplicate key in A"):
        tc.run_ab_test(spark, test, RUN)
    assert spark.table(f"{schema}.result").count() == 1


# -- reports ---------------------------------------------------------------------------------


def test_dashboard_labels(spark):
    names = ["dev_x", "a_test", "prod", "test_dev", "nightly", None]
    rows = [{"test_name": n, "mismatch_count": c} for n, c in zip(names, [0, 1, None, 0, 2, 0])]
    shown = dicts(tc.audit_dashboard(audit_frame(spark, *rows)))
    assert [r["Workspace"] for r in shown] == ["Dev", "Test", "Prod", "Dev", "Unknown", "Unknown"]
    assert [r["Table_mismatch"] for r in shown] == ["No", "Yes", "Yes", "No", "Yes", "No"]


def test_mismatch_predicate(spark):
    clean = {"test_name": "t", "schema_mismatch": False, "data_mismatch": False, "mismatch_count": 0}
    audit = audit_frame(
        spark,
        {**clean, "column_name": "silent"},
        {**clean, "column_name": "clean", "validation_errors": "No errors"},
        {**clean, "column_name": "error", "validation_errors": "bad"},
        {**clean, "column_name": "count", "validation_errors": "No errors", "mismatch_count": 2},
        {**clean, "column_name": "unknown", "validation_errors": "No errors", "mismatch_count": None, "data_mismatch": None},
        {**clean, "column_name": "unnamed", "test_name": None, "validation_errors": "bad"},
    )
    names = lambda df: sorted(r["column_name"] for r in dicts(df))
    assert names(tc.audit_mismatches(audit)) == ["count", "error", "silent"]
    assert names(tc.audit_mismatches(audit, null_is_clean=True)) == ["count", "error"]


def test_rollup_takes_the_first_pair(spark):
    at = lambda day: datetime(2024, 1, day)
    audit = audit_frame(
        spark,
        {"test_name": "t", "table_a": "late", "table_b": "x", "schema_mismatch": True, "run_date": at(2)},
        {"test_name": "t", "table_a": None, "table_b": "y", "schema_mismatch": True, "run_date": at(1)},
        {"test_name": "t", "table_a": "d", "table_b": "e", "data_mismatch": True, "run_date": at(3)},
        {"test_name": "u", "table_a": "ok", "table_b": "ok", "data_mismatch": False, "run_date": at(3)},
    )
    rows = {r["kind"]: r for r in dicts(tc.mismatch_rollup(audit))}
    assert set(rows) == {"schema", "data"}
    assert rows["schema"]["tables"] == "late / y"
    assert rows["data"]["tables"] == "d / e"


def test_summary_rows(spark):
    base = {"test_name": "t", "table_a": "a", "table_b": "b"}
    audit = audit_frame(
        spark,
        {**base, "column_name": "known", "data_mismatch": True},
        {**base, "column_name": "known", "data_mismatch": True},
        {**base, "column_name": "new", "data_mismatch": False},
        {**base, "column_name": None, "data_mismatch": True},
    )
    expected = spark.createDataFrame([("known",), ("known",), (None,)], "column_name string")
    rows = {r["column_name"]: r for r in dicts(tc.audit_summary(audit, expected, "2024-05-01"))}
    assert len(rows) == 3
    assert rows["known"]["mismatch_count"] == 2 and not rows["known"]["schema_mismatch"]
    assert rows["known"]["drill_down_query"] == (
        "SELECT * FROM a WHERE known IS NULL OR known IN (SELECT known FROM b WHERE known IS NULL)"
    )
    assert rows["new"]["schema_mismatch"] and rows["new"]["drill_down_query"] is None
    assert not rows[None]["schema_mismatch"] and rows[None]["drill_down_query"] is None


def test_summary_reads_the_audit_once(spark):
    audit = fx.audit_rows(spark, SF_DIR)
    expected = spark.createDataFrame([("x",)], "column_name string")
    plan = tc.audit_summary(audit, expected)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("/orders.parquet]") == 1  # the file the audit rows come from


def test_reports_on_an_empty_audit(spark):
    audit = empty_audit(spark)
    expected = spark.createDataFrame([], "column_name string")
    for report in (tc.audit_dashboard(audit), tc.audit_mismatches(audit), tc.mismatch_rollup(audit),
                   tc.audit_summary(audit, expected)):
        assert report.count() == 0


def test_unmatched_counts_order_and_zero_rows(spark):
    a = spark.createDataFrame([(1, "x", 1), (2, "x", 1)], "k int, v string, w int")
    b = spark.createDataFrame([(1, "y", 1), (2, "y", 2)], "k int, v string, w int")
    rows = [tuple(r) for r in tc.unmatched_counts(tc.compare_by_key(a, b, ["k"])).collect()]
    assert rows == [("v", 2), ("w", 1), ("k", 0)]


# -- experiment --------------------------------------------------------------------------------


def test_conversion_edges(spark):
    rows = [
        ("e", "A", None, 1, None, "2024-01-01"),
        ("e", "A", 5, 1, 2.0, "2024-01-02"),
        ("e", "B", None, 0, 3.0, "2024-01-01"),
        ("e", None, 7, 1, 1.0, "2024-01-01"),
    ]
    exposures = spark.createDataFrame(
        rows, "experiment_id string, variation string, user_id int, conversion int, time_on_site double, date string"
    )
    report = {(r["variation"], r["date"]): r for r in dicts(tc.conversion_report(exposures))}
    assert len(report) == 3  # rows without a variation join nothing
    first = report[("A", "2024-01-01")]
    assert (first["daily_users"], first["daily_conversion_rate"], first["daily_avg_time_on_site"]) == (0, None, None)
    assert (first["total_users"], first["conversion_rate"], first["avg_time_on_site"]) == (1, 2.0, 2.0)
    assert report[("B", "2024-01-01")]["conversion_rate"] is None
    assert tc.conversion_summary(exposures).count() == 3
    plan = tc.conversion_report(exposures)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


@pytest.mark.parametrize("per_column", [True, False])
@pytest.mark.parametrize("rows", [True, False])
def test_a_run_does_not_read_its_result(spark, schema, monkeypatch, per_column, rows):
    """Counts come from the write; audit rows equal those counted over the written table."""
    base = spark.range(0, 100 if rows else 0).selectExpr("id", "id % 3 AS v", "CAST(NULL AS STRING) AS w")
    base.write.saveAsTable(f"{schema}.t")
    base.withColumn("v", F.when(F.col("id") % 10 == 0, F.lit(9)).otherwise(F.col("v"))).write.saveAsTable(f"{schema}.t_b")
    test = tc.ABTest(f"{schema}.t", f"{schema}.result", f"{schema}.audit", keys=["id"], per_column=per_column, run_label="l")
    read = []
    table = type(spark).table
    monkeypatch.setattr(type(spark), "table", lambda self, name: read.append(name) or table(self, name))
    tc.run_ab_test(spark, test, "2024-01-01")
    assert f"{schema}.result" not in read
    monkeypatch.undo()
    counted = tc.audit_records(
        spark.table(f"{schema}.result"), f"{schema}.t", f"{schema}.t_b", "2024-01-01", "l", per_column)
    assert sorted(map(tuple, spark.table(f"{schema}.audit").collect())) == sorted(map(tuple, counted.collect()))
