"""A key that a third of all rows share: look-up joins are split by adaptive execution."""

import pytest
from pyspark.sql import functions as F

import tablecheck as tc
from tablecheck.operators.sample import rows_of_keys, sample_keys
from tablecheck.sources.scratch import staged

ROWS, KEYS = 120_000, 2_000
SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def thresholds(spark):
    """Scale the cluster's thresholds down to the size of the test."""
    for name, value in SMALL.items():
        spark.conf.set(name, value)
    yield
    for name in SMALL:
        spark.conf.unset(name)


@pytest.fixture
def rows(spark):
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % KEYS).cast("string")))
    return spark.range(0, ROWS, 1, 16).select("id", key.alias("key"))


def keys_of(rows):
    return rows.select("key").distinct()


def was_split(frame):
    frame.collect()
    final = frame._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    return "skew=true" in final


def stored(rows):
    text = F.concat(F.lit("SELECT {{ tbl_"), "key", F.lit(" }} "), F.sha2(F.col("id").cast("string"), 512))
    return rows.select(F.concat(F.lit("d"), "id").alias("domain_cd"), text.alias("domain_value"))


def reference(rows):
    return keys_of(rows).selectExpr("key AS table_cd", "'lake.' || key AS table_path", "NULL AS stage_table_path")


def test_resolved_keys(thresholds, rows):
    resolved = tc.resolve_table_keys(tc.template_table_keys(stored(rows)), reference(rows))
    assert was_split(resolved)
    assert resolved.where("table_path = 'lake.hot'").count() == ROWS // 3


def test_rendered_templates(thresholds, rows):
    out = tc.render_templates(stored(rows), reference(rows))
    assert was_split(out)
    assert out.where("rendered_sql LIKE 'SELECT lake.hot %'").count() == ROWS // 3


def test_sampled_rows(thresholds, rows):
    wide = rows.withColumn("text", F.sha2(F.col("id").cast("string"), 512))
    cut = rows_of_keys(wide, staged(sample_keys(wide, ["key"], 500), "hot-sample"))
    assert was_split(cut)
    assert cut.where("key = 'hot'").count() == ROWS // 3


def test_summary(thresholds, rows):
    audit = rows.select(
        F.concat(F.lit("t"), "id").alias("test_name"), F.lit("a").alias("table_a"), F.lit("b").alias("table_b"),
        F.col("key").alias("column_name"), F.lit(True).alias("schema_mismatch"), F.lit(True).alias("data_mismatch"),
    )
    summary = tc.audit_summary(audit, keys_of(rows).selectExpr("key AS column_name"), "2024-01-01")
    assert was_split(summary)
    assert summary.count() == ROWS and summary.where("schema_mismatch").count() == 0
