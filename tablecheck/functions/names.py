"""Column and table name handling shared by the operators."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Suffixes and column names of a comparison row.
SUFFIX_A = "_a"
SUFFIX_B = "_b"
SUFFIX_RESULT = "_result"
VERDICT = "validation_result"
NOT_COMPARED = "not_compared"
COPIES_A = "copies_a"
COPIES_B = "copies_b"

_TIME_TYPES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def quoted(name: str) -> str:
    """Backtick-quote one column name so dots and spaces survive."""
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    return F.col(quoted(name))


def suffixed(df: DataFrame, suffix: str) -> DataFrame:
    """Append ``suffix`` to every column name in one projection."""
    return df.toDF(*[c + suffix for c in df.columns])


def trimmed_names(names: list[str]) -> list[str]:
    """Strip blanks round column names; two names that become one are an error."""
    cleaned = [name.strip() for name in names]
    clashes = sorted(name for name, n in Counter(cleaned).items() if n > 1)
    if clashes:
        raise ValueError(f"column names collide after trimming: {', '.join(clashes)}")
    return cleaned


def holds(dtype: T.DataType, kind: type[T.DataType]) -> bool:
    """Whether a type is of ``kind`` or has it anywhere inside."""
    if isinstance(dtype, kind):
        return True
    if isinstance(dtype, T.ArrayType):
        return holds(dtype.elementType, kind)
    if isinstance(dtype, T.MapType):
        return holds(dtype.keyType, kind) or holds(dtype.valueType, kind)
    return isinstance(dtype, T.StructType) and any(holds(f.dataType, kind) for f in dtype.fields)


def aligned(a: DataFrame, b: DataFrame) -> DataFrame:
    """``b`` with its columns spelled as in ``a``, where the session ignores case."""
    if b.sparkSession.conf.get("spark.sql.caseSensitive") == "true":
        return b
    spelled = {c.lower(): c for c in a.columns}
    names = [c if c in a.columns else spelled.get(c.lower(), c) for c in b.columns]
    return b if names == b.columns or len(set(names)) < len(names) else b.toDF(*names)


def same_kind(left: T.DataType, right: T.DataType) -> bool:
    """True when ``=`` between the two types is well defined without parsing text."""
    if holds(left, T.VariantType) or holds(right, T.VariantType):
        return False
    if left.simpleString() == right.simpleString():
        return True
    if isinstance(left, T.NumericType) and isinstance(right, T.NumericType):
        return True
    return isinstance(left, _TIME_TYPES) and isinstance(right, _TIME_TYPES)


def comparable_columns(a: DataFrame, b: DataFrame) -> list[str]:
    """Columns of ``a``, in order, that ``b`` also has with a comparable type."""
    types_b = {f.name: f.dataType for f in b.schema.fields}
    return [
        f.name
        for f in a.schema.fields
        if f.name in types_b and same_kind(f.dataType, types_b[f.name])
    ]


def uncompared_columns(a: DataFrame, b: DataFrame) -> list[str]:
    """Columns both tables have, of types that cannot be compared."""
    compared = comparable_columns(a, b)
    return [c for c in a.columns if c in b.columns and c not in compared]


def compared_columns(comparison: DataFrame) -> list[str]:
    """Base names of the columns flagged in a comparison result, in order; those that were
    not compared are marked in the metadata of their flag."""
    present = set(comparison.columns)
    bases = [
        f.name[: -len(SUFFIX_RESULT)]
        for f in comparison.schema.fields
        if f.name.endswith(SUFFIX_RESULT) and f.name != VERDICT and not f.metadata.get(NOT_COMPARED)
    ]
    return [c for c in bases if c + SUFFIX_A in present and c + SUFFIX_B in present]


def has_copies(comparison: DataFrame) -> bool:
    return COPIES_A in comparison.columns and COPIES_B in comparison.columns


def last_part(table_name: str) -> tuple[str, str]:
    """Split ``catalog.schema.table`` into its prefix (with the dot) and last part."""
    head, dot, tail = table_name.rpartition(".")
    return head + dot, tail
