"""Match flags, row verdicts and row weights of a comparison."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecheck.functions.names import (
    COPIES_A,
    COPIES_B,
    SUFFIX_RESULT,
    column,
    has_copies,
    holds,
    quoted,
)

# Flag labels, and the labels of the unmatched-rows report.
MATCH = "match"
UNMATCH = "unmatch"
UNCOMPARED = "uncompared"
REPORT_UNMATCHED = "unmatched"


def orderable(value: Column, dtype: T.DataType) -> Column:
    """Maps support neither ``=`` nor ordering; compare them, at any depth, as sorted entry
    lists."""
    if not holds(dtype, T.MapType):
        return value
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda v: orderable(v, dtype.elementType))
    if isinstance(dtype, T.StructType):
        fields = [orderable(value.getField(f.name), f.dataType).alias(f"f{i}") for i, f in enumerate(dtype.fields)]
        return F.when(value.isNotNull(), F.struct(*fields))
    entries = F.map_entries(value)
    if holds(dtype.valueType, T.MapType):
        entries = F.transform(entries, lambda e: F.struct(
            e["key"].alias("key"), orderable(e["value"], dtype.valueType).alias("value")
        ))
    return F.array_sort(entries)


def exactly_paired(left: Column, right: Column, type_a: T.DataType, type_b: T.DataType) -> tuple[Column, Column]:
    """A whole number against a floating one: the floating one as the whole number it is,
    NULL if it is none, so that nothing is rounded before it is compared."""
    if isinstance(type_a, T.IntegralType) and isinstance(type_b, T.FractionalType):
        return left.cast("bigint"), _whole_number(right, type_b)
    if isinstance(type_b, T.IntegralType) and isinstance(type_a, T.FractionalType):
        return _whole_number(left, type_a), right.cast("bigint")
    return left, right


def _whole_number(value: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.DecimalType):
        return value
    # what is no whole number must differ from every one, NULL included
    whole = value.try_cast("bigint")
    return F.when(value.isNull(), F.lit(None)).when(
        (value < F.lit(2.0**63)) & (whole.cast(dtype) == value), whole.cast("decimal(20,0)")
    ).otherwise(F.lit("99999999999999999999").cast("decimal(20,0)"))


def _balanced(columns: Iterable[Column], combine: Callable[[Column, Column], Column]) -> Column:
    """Combine pairwise, so that a thousand columns nest ten deep and not a thousand."""
    level = list(columns)
    while len(level) > 1:
        paired = [combine(x, y) for x, y in zip(level[::2], level[1::2])]
        level = paired + level[len(paired) * 2:]
    return level[0]


def all_of(columns: Iterable[Column]) -> Column:
    return _balanced(columns, and_)


def any_of(columns: Iterable[Column]) -> Column:
    return _balanced(columns, or_)


def any_null(names: list[str]) -> Column:
    return any_of(column(c).isNull() for c in names)


def agreement(left: Column, right: Column, null_equal: bool, in_both: Column | None) -> Column:
    """True where two values agree; false or NULL where they do not.

    With ``null_equal`` two NULLs agree, so a row missing on one side has to be
    recognised by ``in_both`` and not by its NULLs.
    """
    return in_both & left.eqNullSafe(right) if null_equal else left == right


def match_label(agrees: Column) -> Column:
    """``match`` or ``unmatch``; a NULL test falls through to ``unmatch``."""
    return F.when(agrees, MATCH).otherwise(UNMATCH)


def is_unmatched(flag_name: str) -> Column:
    return column(flag_name) == UNMATCH


def any_unmatched(names: list[str]) -> Column:
    return any_of(is_unmatched(c + SUFFIX_RESULT) for c in names)


def row_weight(comparison: DataFrame) -> Column:
    """Joined rows one comparison row stands for (see ``compare_all_columns``)."""
    if has_copies(comparison):
        return F.greatest(F.col(COPIES_A), F.col(COPIES_B))
    return F.lit(1).cast("bigint")


def unmatched_counters(comparison: DataFrame, flags: Iterable[str]) -> list[Column]:
    """For each flag column the aggregate that counts the rows it calls unmatched."""
    weight, none = row_weight(comparison), F.lit(0).cast("bigint")
    return [F.coalesce(F.sum(F.when(is_unmatched(flag), weight).otherwise(none)), none) for flag in flags]


def unmatched_totals(comparison: DataFrame, flags: dict[str, str]) -> DataFrame:
    """``column_name, mismatch_count`` for every ``name: flag column`` given.

    One aggregate for all flags, turned on its side afterwards.
    """
    counters = unmatched_counters(comparison, flags.values())
    totals = comparison.agg(*[count.alias(name) for name, count in zip(flags, counters)])
    return totals.unpivot([], [quoted(name) for name in flags], "column_name", "mismatch_count")
