"""One text per row, and digests of it.

Two forms. ``plain`` joins the values with commas and drops NULLs, so different rows
can share a text (``('a,b','c')`` and ``('a','b,c')``). ``canonical`` escapes the
separator and marks NULL, so equal text means equal values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecheck.functions.names import column

# Separator, escape and NULL marker of the row text.
SEPARATOR = ","
ESCAPE = "\\"
NULL_MARK = "\\N"

_NESTED = (T.ArrayType, T.StructType, T.MapType, T.VariantType)


def _scalar_text(value: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return (value + F.lit(0.0).cast(dtype)).cast("string")  # -0.0 becomes 0.0
    if isinstance(dtype, T.BinaryType):
        return F.hex(value)
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(value).cast("string")  # independent of the session time zone
    return value.cast("string")


def _spelled(value: Column, dtype: T.DataType) -> Column:
    """The value with the text of its scalars at every depth, map entries sorted."""
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda v: _spelled(v, dtype.elementType))
    if isinstance(dtype, T.StructType):
        fields = [_spelled(value.getField(f.name), f.dataType).alias(f"f{i}") for i, f in enumerate(dtype.fields)]
        return F.when(value.isNotNull(), F.struct(*fields)) if fields else value
    if isinstance(dtype, T.MapType):
        entries = F.transform(F.map_entries(value), lambda e: F.struct(
            _spelled(e["key"], dtype.keyType).alias("k"), _spelled(e["value"], dtype.valueType).alias("v")
        ))
        return F.array_sort(entries)
    if isinstance(dtype, T.VariantType):
        return F.to_json(value)
    return _scalar_text(value, dtype)


def value_text(value: Column, dtype: T.DataType) -> Column:
    """Text of one value, equal for values that ``=`` calls equal; NULL stays NULL."""
    if isinstance(dtype, _NESTED):
        body = F.struct(_spelled(value, dtype).alias("v"))
        return F.when(value.isNotNull(), F.to_json(body, {"ignoreNullFields": "false"}))
    return _scalar_text(value, dtype)


def plain_text(df: DataFrame, names: list[str] | None = None) -> Column:
    names = df.columns if names is None else names
    return F.concat_ws(SEPARATOR, *[column(c).cast("string") for c in names])


def canonical_text(df: DataFrame, names: list[str] | None = None) -> Column:
    names = df.columns if names is None else names
    types = {f.name: f.dataType for f in df.schema.fields}
    parts = []
    for name in names:
        text = value_text(column(name), types[name])
        if isinstance(types[name], (T.StringType, *_NESTED)):  # others hold no separator
            text = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2))
            text = F.replace(text, F.lit(SEPARATOR), F.lit(ESCAPE + SEPARATOR))
        parts.append(F.coalesce(text, F.lit(NULL_MARK)))
    return F.concat_ws(SEPARATOR, *parts)


def row_text(df: DataFrame, form: str = "canonical", names: list[str] | None = None) -> Column:
    if form == "canonical":
        return canonical_text(df, names)
    if form == "plain":
        return plain_text(df, names)
    raise ValueError(f"unknown row text form: {form}")


def digest(text: Column, algo: str) -> Column:
    """The row checksum itself: 32 hex digits for md5, a bigint for crc32."""
    if algo == "md5":
        return F.md5(text)
    if algo == "crc32":
        return F.crc32(text)
    raise ValueError(f"unknown checksum algorithm: {algo}")


def digest_words(text: Column, algo: str) -> list[Column]:
    """The whole digest as numbers in [0, 2^32) to add up over a table: one for crc32, four
    for md5."""
    if algo == "md5":
        return [F.conv(F.substring(digest(text, algo), at, 8), 16, 10).cast("bigint") for at in (1, 9, 17, 25)]
    return [digest(text, algo)]
