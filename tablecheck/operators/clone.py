"""Table cloning from a declarative spec."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecheck.sources.tables import partition_columns, replace_table

# Option keys and copy methods of a clone spec.
OPTION_METHOD = "copy_method"
OPTION_FILTER = "filter_condition"
METHOD_FULL = "Deep clone"
METHOD_FILTERED = "select_into"

RESULT_SCHEMA = "source string, target string, method string, rows bigint"


def clone_full(spark: SparkSession, source: str, target: str, fmt: str = "parquet") -> int:
    """Copy a whole table, keeping its partition columns; returns the rows copied."""
    _check_distinct(source, target)
    return replace_table(spark.table(source), target, fmt, partition_columns(spark, source))


def clone_filtered(
    spark: SparkSession, source: str, target: str, condition: str | Column | None = None,
    fmt: str = "parquet",
) -> int:
    """Copy the rows that satisfy ``condition``, which Catalyst pushes into the scan."""
    _check_distinct(source, target)
    rows = spark.table(source)
    if condition is not None:
        rows = rows.where(condition)
    return replace_table(rows, target, fmt, partition_columns(spark, source))


def clone_tables(
    spark: SparkSession, spec: Mapping, schema: str, target_schema: str | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Clone every table of ``spec`` and report source, target, method and rows.

    ``spec`` is ``{"tables": [{"table": t, "options": [{"key": k, "value": v}]}]}``; the
    source is ``<schema>.<t>`` and the target ``<schema>_<t>``. The whole spec is checked
    before the first copy starts.
    """
    plan = [_entry(table) for table in spec.get("tables") or []]
    done = []
    for table, method, condition in plan:
        source = f"{schema}.{table}"
        target = f"{schema}_{table}" if target_schema is None else f"{target_schema}.{schema}_{table}"
        if method == METHOD_FULL:
            rows = clone_full(spark, source, target, fmt)
        else:
            rows = clone_filtered(spark, source, target, condition, fmt)
        done.append((source, target, method, rows))
    return spark.createDataFrame(done, RESULT_SCHEMA)


def read_clone_spec(spark: SparkSession, path: str) -> dict:
    """Read a YAML or JSON spec file from any storage Spark can reach."""
    text = spark.read.text(path, wholetext=True).first()[0]
    if text.lstrip().startswith("{"):
        return json.loads(text)
    try:
        import yaml
    except ImportError as missing:
        raise ImportError(f"{path} is no JSON; reading YAML needs the yaml library (PyYAML)") from missing
    return yaml.safe_load(text)


def spec_from_rows(rows: DataFrame) -> dict:
    """Spec from a DataFrame with ``table`` and ``options array<struct<key,value>>``."""
    listed = rows.select("table", F.col("options").alias("options")).toLocalIterator()
    return {"tables": [r.asDict(recursive=True) for r in listed]}


def _entry(table: Mapping) -> tuple[str, str, str | None]:
    options = {o["key"]: o["value"] for o in reversed(table.get("options") or [])}
    method = options.get(OPTION_METHOD)
    if method not in (METHOD_FULL, METHOD_FILTERED):
        raise ValueError(f"unsupported copy method for {table['table']}: {method}")
    return table["table"], method, options.get(OPTION_FILTER)


def _check_distinct(source: str, target: str) -> None:
    if source == target:
        raise ValueError(f"cannot clone {source} onto itself")
