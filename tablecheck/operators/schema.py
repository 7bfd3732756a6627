"""Schema comparison. Reads only table metadata; starts no job."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

DIFF_SCHEMA = T.StructType([
    T.StructField("column_name", T.StringType()),
    T.StructField("side", T.StringType()),
    T.StructField("type_a", T.StringType()),
    T.StructField("type_b", T.StringType()),
    T.StructField("nullable_a", T.BooleanType()),
    T.StructField("nullable_b", T.BooleanType()),
    T.StructField("kind", T.StringType()),
])


def diff_rows(a: T.StructType, b: T.StructType) -> list[tuple]:
    """One entry per difference in name, type, nullability or metadata; order is ignored."""
    fields_a = {f.name: f for f in a.fields}
    fields_b = {f.name: f for f in b.fields}
    rows = []
    for name in [*fields_a, *[n for n in fields_b if n not in fields_a]]:
        left, right = fields_a.get(name), fields_b.get(name)
        for kind in _kinds(left, right):
            side = {"only_a": "a", "only_b": "b"}.get(kind, "both")
            rows.append((
                name, side,
                left and left.dataType.simpleString(), right and right.dataType.simpleString(),
                left and left.nullable, right and right.nullable, kind,
            ))
    return rows


def _kinds(left: T.StructField | None, right: T.StructField | None) -> list[str]:
    if right is None:
        return ["only_a"]
    if left is None:
        return ["only_b"]
    found = []
    if left.dataType != right.dataType:
        found.append("type")
    if left.nullable != right.nullable:
        found.append("nullable")
    if json.dumps(left.metadata, sort_keys=True) != json.dumps(right.metadata, sort_keys=True):
        found.append("metadata")
    return found


def schema_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Schema differences of two tables; empty when the schemas are identical."""
    return a.sparkSession.createDataFrame(diff_rows(a.schema, b.schema), DIFF_SCHEMA)


def schema_diffs(pairs: Iterable[tuple[str, DataFrame, DataFrame]]) -> DataFrame:
    """``schema_diff`` of many named pairs in one DataFrame, keyed by ``pair``."""
    pairs = list(pairs)
    if not pairs:
        raise ValueError("no table pair given")
    rows = [(name, *row) for name, a, b in pairs for row in diff_rows(a.schema, b.schema)]
    schema = T.StructType([T.StructField("pair", T.StringType()), *DIFF_SCHEMA.fields])
    return pairs[0][1].sparkSession.createDataFrame(rows, schema)


def differing_columns(a: T.StructType, b: T.StructType) -> dict[str, str]:
    """Column name to the kinds of its differences, e.g. ``{"x": "type, nullable"}``."""
    found: dict[str, list[str]] = {}
    for row in diff_rows(a, b):
        found.setdefault(row[0], []).append(row[-1])
    return {name: ", ".join(kinds) for name, kinds in found.items()}
