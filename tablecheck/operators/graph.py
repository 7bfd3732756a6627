"""Entities as graph nodes: one row per key, replaced by key on upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecheck.functions.flags import orderable
from tablecheck.functions.names import column, holds


def _required(key: str) -> Column:
    message = F.lit(f"node key {key} is NULL")
    kind = F.raise_error(message)
    return F.when(column(key).isNull(), kind).otherwise(column(key)).alias(key)


def _ranking(value: Column, dtype: T.DataType) -> Column:
    if not holds(dtype, T.VariantType):
        return orderable(value, dtype)
    return F.to_json(value if isinstance(dtype, T.VariantType) else F.struct(value.alias("v")))


def graph_nodes(df: DataFrame, label: str, key: str, order_by: Sequence[str] = ()) -> DataFrame:
    """``label``, the key and the property columns, one row per key.

    Rows of one key collapse to the greatest by ``order_by`` (e.g. an update time), then
    by value; the collapse combines before the shuffle, so a hot key costs no more than
    any other. Maps rank by their sorted entries, variants by their JSON text. A NULL key
    fails the query.
    """
    nodes, properties = _collapsed(df, key, order_by), [c for c in df.columns if c != key]
    return nodes.select(F.lit(label).alias("label"), column(key), *map(column, properties))


def _collapsed(df: DataFrame, key: str, order_by: Sequence[str] = ()) -> DataFrame:
    """One row per key: the greatest by ``order_by`` and then by value."""
    types = {f.name: f.dataType for f in df.schema.fields}
    properties = [c for c in df.columns if c != key]
    rank = [*order_by, *[c for c in properties if c not in order_by]]
    keyed = df.select(_required(key), *[column(c) for c in properties])
    if not properties:
        return keyed.distinct()
    ranked = F.struct(*[_ranking(column(c), types[c]).alias(f"r{i}") for i, c in enumerate(rank)])
    values = F.struct(*[column(c) for c in properties])
    best = keyed.groupBy(column(key)).agg(F.max_by(values, ranked).alias("__best"))
    return best.select(column(key), *[F.col("__best")[c].alias(c) for c in properties])


def upsert_nodes(existing: DataFrame, new: DataFrame, key: str, order_by: Sequence[str] = ()) -> DataFrame:
    """Existing nodes with the new ones put in, replacing those of equal key.

    New rows of one key collapse as in ``graph_nodes``. A property that only one side has is
    kept, NULL on the nodes of the other.
    """
    arriving = _collapsed(new, key, order_by)
    replaced = new.select(column(key).alias("__new_key"))
    kept = existing.join(replaced, column(key) == F.col("__new_key"), "left_anti")
    return kept.unionByName(arriving, allowMissingColumns=True)
