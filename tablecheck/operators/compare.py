"""Row and column comparison of two versions of a table.

Result layout (a *comparison*): every column of A as ``<c>_a``, every column of B as
``<c>_b``, one ``<c>_result`` flag per compared column, and ``validation_result``.
``compare_all_columns`` and the ``pair`` form also carry ``copies_a``/``copies_b``:
identical rows are folded into one row that counts them, so a value repeated a billion
times is one row through the shuffle instead of one task full of copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecheck.functions.flags import (
    MATCH,
    REPORT_UNMATCHED,
    UNCOMPARED,
    UNMATCH,
    agreement,
    all_of,
    any_null,
    any_unmatched,
    exactly_paired,
    is_unmatched,
    match_label,
    orderable,
)
from tablecheck.functions.names import (
    COPIES_A,
    COPIES_B,
    NOT_COMPARED,
    SUFFIX_A,
    SUFFIX_B,
    SUFFIX_RESULT,
    VERDICT,
    aligned,
    column,
    comparable_columns,
    compared_columns,
    has_copies,
    suffixed,
    uncompared_columns,
)
from tablecheck.functions.rowtext import canonical_text
from tablecheck.sources.scratch import staged

# The differing rows of a key with more than ``LANE_ROWS`` rows are numbered in 65,536
# independent lanes, so the largest unit of work for a key holding a third of a table is a
# 65,536th of it.
LANE_ROWS = 50_000
_LANE_DIGITS = 4

_IN_A, _IN_B = "__in_a", "__in_b"
_KEY, _SIDE, _LANE, _RANK, _ORDER = "__key", "__side", "__lane", "__rank", "__order"
_SHARE = "__share"


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row, with their row count (NULL keys included)."""
    counted = df.groupBy(*[column(k) for k in keys]).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.where("row_count > 1")


def compare_by_key(
    a: DataFrame,
    b: DataFrame,
    keys: list[str],
    null_equal: bool = False,
    on_duplicate: str = "error",
) -> DataFrame:
    """Full outer comparison on ``keys``.

    ``null_equal=False``: NULL differs from everything, NULL keys included.
    ``null_equal=True``: NULL equals NULL, in keys and in values.
    ``on_duplicate="error"``: a repeated key raises, after a job that counts the key columns.
    ``on_duplicate="pair"``: rows of one key are paired one to one, equal rows first,
    the rest in a fixed order; rows left over stay one-sided. Keys with very many rows are
    counted first, by a job that reads the key columns.

    Columns of types that cannot be compared are carried, flagged ``uncompared``.
    """
    b = aligned(a, b)
    compared = comparable_columns(a, b)
    _check_keys(a, b, keys, compared)
    if on_duplicate == "error":
        joined = _join_unique(a, b, keys, null_equal)
    elif on_duplicate == "pair":
        joined = _pair_copies(a, b, keys, compared, null_equal)
    else:
        raise ValueError(f"on_duplicate must be 'error' or 'pair', not {on_duplicate!r}")
    return _flagged(joined, a, b, compared, null_equal)


def compare_all_columns(a: DataFrame, b: DataFrame) -> DataFrame:
    """Full outer comparison on all common columns at once, NULL never equal.

    A row with m copies in A and n in B stands for m x n joined rows; it is returned
    once, with ``copies_a = m`` and ``copies_b = n``. Rows found on one side only have
    the other count 0. One aggregation, no join, nothing multiplied out.
    """
    b = aligned(a, b)
    compared = comparable_columns(a, b)
    if not compared:
        raise ValueError("the tables have no comparable column in common")
    folded = _fold_copies(a, b, compared)
    n_a, n_b = F.col(COPIES_A), F.col(COPIES_B)
    found = ~any_null(compared) & (n_a > 0) & (n_b > 0)
    zero = F.lit(0).cast("bigint")
    same = {c: column(c) for c in compared}
    joined = _opened(
        folded, same, same,
        together=(F.when(found, n_a).otherwise(zero), F.when(found, n_b).otherwise(zero)),
        only_a=F.when(found, zero).otherwise(n_a),
        only_b=F.when(found, zero).otherwise(n_b),
    )
    return _flagged(joined, a.select(*map(column, compared)), b.select(*map(column, compared)),
                    compared, null_equal=False)


def compare_multiset(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows whose number of copies differs, with ``copies_a`` and ``copies_b``.

    NULL-safe and order-free; empty when the tables hold the same rows. One shuffle,
    copies are combined before it.
    """
    b = aligned(a, b)
    compared = _same_columns(a, b)
    return _fold_copies(a, b, compared).where(F.col(COPIES_A) != F.col(COPIES_B))


def unmatched_rows(comparison: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows where any of ``columns`` (default: all) differs, labelled ``unmatched``.

    By default rows that only hold columns that were not compared are kept too, with the
    verdict they have: nothing says that they match.
    """
    if columns is None:
        label = F.when(is_unmatched(VERDICT), F.lit(REPORT_UNMATCHED)).otherwise(column(VERDICT))
        return comparison.where(column(VERDICT) != MATCH).withColumn(VERDICT, label)
    condition = any_unmatched(columns)
    return comparison.where(condition).withColumn(VERDICT, F.lit(REPORT_UNMATCHED))


def drill_down(comparison: DataFrame, name: str) -> DataFrame:
    """The rows of A and B behind one column's mismatch count."""
    if name not in compared_columns(comparison):
        raise ValueError(f"column {name!r} is not part of the comparison")
    bases = [c for c in comparison.columns if not c.endswith(SUFFIX_RESULT)]
    return comparison.where(is_unmatched(name + SUFFIX_RESULT)).select(
        *[column(c) for c in bases], column(name + SUFFIX_RESULT)
    )


# -- layout ------------------------------------------------------------------------


def _flagged(
    joined: DataFrame, a: DataFrame, b: DataFrame, compared: list[str], null_equal: bool
) -> DataFrame:
    """Add flags and verdict to joined rows and drop the presence markers."""
    types_a = {f.name: f.dataType for f in a.schema.fields}
    types_b = {f.name: f.dataType for f in b.schema.fields}
    in_both = F.col(_IN_A) & F.col(_IN_B) if null_equal else None
    values = {c: column(c) for c in [*[c + SUFFIX_A for c in a.columns], *[c + SUFFIX_B for c in b.columns]]}
    agrees = {}
    for c in compared:
        pair = exactly_paired(values[c + SUFFIX_A], values[c + SUFFIX_B], types_a[c], types_b[c])
        sides = [orderable(v, t) for v, t in zip(pair, (types_a[c], types_b[c]))]
        agrees[c + SUFFIX_RESULT] = agreement(*sides, null_equal, in_both)
    carried = [c + SUFFIX_RESULT for c in uncompared_columns(a, b)]
    verdict = match_label(all_of(agrees.values()))
    if carried:
        verdict = F.when(verdict == UNMATCH, verdict).otherwise(F.lit(UNCOMPARED))
    counts = [COPIES_A, COPIES_B] if has_copies(joined) else []
    names = [*values, *agrees, *carried, VERDICT, *counts]
    if len(set(names)) < len(names):
        raise ValueError("a column name clashes with a name of the comparison layout")
    return joined.select(
        *values.values(),
        *[match_label(same).alias(flag) for flag, same in agrees.items()],
        *[F.lit(UNCOMPARED).alias(flag, metadata={NOT_COMPARED: True}) for flag in carried],
        verdict.alias(VERDICT),
        *counts,
    )


def _check_keys(a: DataFrame, b: DataFrame, keys: list[str], compared: list[str]) -> None:
    if not keys:
        raise ValueError("at least one key column is needed")
    for side, df in (("A", a), ("B", b)):
        missing = [k for k in keys if k not in df.columns]
        if missing:
            raise ValueError(f"key columns missing in {side}: {', '.join(missing)}")
    unlike = [k for k in keys if k not in compared or _rounds(a.schema[k].dataType, b.schema[k].dataType)]
    if unlike:
        raise ValueError(f"key columns of incomparable type: {', '.join(unlike)}")


def _rounds(left: T.DataType, right: T.DataType) -> bool:
    """Whether joining the two would round whole numbers to floating ones."""
    floating = (T.FloatType, T.DoubleType)
    return isinstance(left, floating) != isinstance(right, floating)


def _same_columns(a: DataFrame, b: DataFrame) -> list[str]:
    compared = comparable_columns(a, b)
    uncommon = sorted((set(a.columns) | set(b.columns)) - set(compared))
    if uncommon:
        raise ValueError(f"columns missing or of different type on one side: {', '.join(uncommon)}")
    return compared


# -- unique keys: one sort-merge join -----------------------------------------------


def _join_unique(a: DataFrame, b: DataFrame, keys: list[str], null_equal: bool) -> DataFrame:
    left = suffixed(a, SUFFIX_A).withColumn(_IN_A, F.lit(True))
    right = suffixed(b, SUFFIX_B).withColumn(_IN_B, F.lit(True))
    left, keys_a = _with_join_keys(left, a, b, keys, SUFFIX_A)
    right, keys_b = _with_join_keys(right, a, b, keys, SUFFIX_B)
    helpers = [c for c in keys_a + keys_b if c.startswith(_KEY)]
    same = all_of(column(x) == column(y) for x, y in zip(keys_a, keys_b))
    if not _checked_keys({"A": (left, keys_a), "B": (right, keys_b)}, null_equal):
        return left.join(right, same, "full_outer").drop(*helpers)

    # NULL keys go round the join of the others: with NULL unequal they join nothing but
    # would all hash to one full-outer partition, which AQE cannot split; with NULL equal
    # they need a key that compares NULLs, which would cost bucketed tables their layout.
    # The extra scan is an IS NULL filter, pushed to the row-group statistics.
    lone_a, lone_b = left.where(any_null(keys_a)), right.where(any_null(keys_b))
    left, right = left.where(~any_null(keys_a)), right.where(~any_null(keys_b))
    joined = left.join(right, same, "full_outer")
    if null_equal:
        # a struct is never NULL itself and compares NULL fields as equal
        lone_a = lone_a.withColumn(_KEY, _key_struct(keys_a))
        lone_b = lone_b.withColumn(_KEY, _key_struct(keys_b))
        lone = [lone_a.join(lone_b, lone_a[_KEY] == lone_b[_KEY], "full_outer").drop(_KEY)]
    else:
        lone = [lone_a, lone_b]
    for part in lone:
        joined = joined.unionByName(part, allowMissingColumns=True)
    return joined.drop(*helpers)


def _with_join_keys(
    df: DataFrame, a: DataFrame, b: DataFrame, keys: list[str], suffix: str
) -> tuple[DataFrame, list[str]]:
    """The names to join on. A key of different type in A and B gets a widened copy, so
    that the duplicate check and the join partition by the same expression."""
    names = []
    for i, key in enumerate(keys):
        if a.schema[key].dataType == b.schema[key].dataType:
            names.append(key + suffix)
            continue
        both = a.select(column(key).alias("k")).unionAll(b.select(column(key).alias("k")))
        names.append(f"{_KEY}{i}{suffix}")
        df = df.withColumn(names[-1], column(key + suffix).cast(both.schema["k"].dataType))
    return df, names


def _key_struct(names: list[str]) -> Column:
    return F.struct(*[column(c).alias(f"k{i}") for i, c in enumerate(names)])


def _checked_keys(sides: dict[str, tuple[DataFrame, list[str]]], null_equal: bool) -> bool:
    """Whether any key is NULL; a repeated key raises.

    A job of its own, over the key columns alone, that ends before the join is planned: a
    key held by very many rows of both sides never gets to be joined. Keys are counted with
    a combined aggregate, one a side, so no task holds the rows of a key; a bucketed table
    is counted where it lies. NULL keys may repeat unless NULL equals NULL.
    """
    facts = []
    for side, (df, keys) in sides.items():
        counted = df.groupBy(*[column(k) for k in keys]).agg(F.count(F.lit(1)).alias("row_count"))
        missing = any_null(keys)
        repeated = F.col("row_count") > 1 if null_equal else (F.col("row_count") > 1) & ~missing
        shown = F.to_json(F.struct(*[column(k) for k in keys]))
        facts.append(counted.agg(
            F.lit(side).alias("side"), F.max(F.when(repeated, shown)).alias("repeated"), F.bool_or(missing).alias("nulls")
        ))
    found = facts[0].unionAll(facts[1]).collect()
    for row in sorted(found):
        if row["repeated"] is not None:
            raise ValueError(f"duplicate key in {row['side']}: {row['repeated']}")
    return any(row["nulls"] for row in found)


# -- repeated rows: fold copies, then pair what differs -----------------------------


def _fold_copies(a: DataFrame, b: DataFrame, names: list[str]) -> DataFrame:
    """Distinct rows over both sides with their number of copies on each."""
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    side_a = a.select(*map(column, names), one.alias(COPIES_A), zero.alias(COPIES_B))
    side_b = b.select(*map(column, names), zero.alias(COPIES_A), one.alias(COPIES_B))
    if {COPIES_A, COPIES_B} & set(names):
        raise ValueError("a column name clashes with a name of the comparison layout")
    return (
        side_a.unionByName(side_b)
        .groupBy(*map(column, names))
        .agg(F.sum(COPIES_A).alias(COPIES_A), F.sum(COPIES_B).alias(COPIES_B))
    )


def _opened(
    df: DataFrame,
    values_a: dict[str, Column],
    values_b: dict[str, Column],
    together: tuple[Column, Column],
    only_a: Column,
    only_b: Column,
) -> DataFrame:
    """Open one row into its shares: copies on both sides, only in A, only in B.

    Each non-empty share becomes one output row. The shares are numbered by a plain
    integer array, which keeps the expansion inside generated code.
    """
    zero = F.lit(0).cast("bigint")
    copies = [together, (only_a, zero), (zero, only_b)]
    filled = [F.when((n_a > 0) | (n_b > 0), i).otherwise(-1) for i, (n_a, n_b) in enumerate(copies)]
    opened = df.withColumn(_SHARE, F.explode(F.array_remove(F.array(*filled), -1)))
    in_a, in_b = F.col(_SHARE) != 2, F.col(_SHARE) != 1
    return opened.select(
        *[F.when(in_a, v).alias(c + SUFFIX_A) for c, v in values_a.items()],
        *[F.when(in_b, v).alias(c + SUFFIX_B) for c, v in values_b.items()],
        F.get(F.array(*[n_a for n_a, _ in copies]), _SHARE).alias(COPIES_A),
        F.get(F.array(*[n_b for _, n_b in copies]), _SHARE).alias(COPIES_B),
        in_a.alias(_IN_A),
        in_b.alias(_IN_B),
    )


def _pair_copies(
    a: DataFrame, b: DataFrame, keys: list[str], compared: list[str], null_equal: bool
) -> DataFrame:
    names = _same_columns(a, b)
    folded = _fold_copies(a, b, names)
    joins = F.lit(True) if null_equal else ~any_null(keys)
    n_a, n_b = F.col(COPIES_A), F.col(COPIES_B)
    equal = F.when(joins, F.least(n_a, n_b)).otherwise(F.lit(0).cast("bigint"))
    zero = F.lit(0).cast("bigint")
    same = {c: column(c) for c in names}

    settled = _opened(
        folded, same, same,
        together=(equal, equal),
        only_a=F.when(joins, zero).otherwise(n_a),
        only_b=F.when(joins, zero).otherwise(n_b),
    )

    open_a, open_b = "__open_a", "__open_b"
    differing = (
        folded.withColumn(open_a, F.when(joins, n_a - equal).otherwise(zero))
        .withColumn(open_b, F.when(joins, n_b - equal).otherwise(zero))
        .where((F.col(open_a) > 0) | (F.col(open_b) > 0))
    )
    ranked = _ranked_in_key(differing, keys, names, F.col(open_a) > 0, _crowded_keys(a, b, keys))
    row = F.struct(*map(column, names))
    # At most one row per key, rank and side, so ``first`` has nothing to choose from.
    met = ranked.groupBy(_KEY, _RANK).agg(
        F.first(F.when(F.col(_SIDE), row), ignorenulls=True).alias("__row_a"),
        F.first(F.when(~F.col(_SIDE), row), ignorenulls=True).alias("__row_b"),
        F.sum(open_a).alias(open_a),
        F.sum(open_b).alias(open_b),
    )
    both = F.least(open_a, open_b)
    paired = _opened(
        met,
        {c: F.col("__row_a")[c] for c in names},
        {c: F.col("__row_b")[c] for c in names},
        together=(both, both),
        only_a=F.col(open_a) - both,
        only_b=F.col(open_b) - both,
    )
    return settled.unionByName(paired)


def _crowded_keys(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame | None:
    """Keys with more than ``LANE_ROWS`` rows, written so that their number is known; None if
    there are none."""
    by_key = [column(k) for k in keys]
    counted = a.select(*by_key).unionAll(b.select(*by_key)).groupBy(*by_key).agg(F.count(F.lit(1)).alias("__n"))
    most = counted.agg(F.max("__n")).first()[0] or 0
    if most <= LANE_ROWS:
        return None
    return staged(counted.where(F.col("__n") > LANE_ROWS).select(_key_struct(keys).alias("__crowded")), "crowded")


def _ranked_in_key(
    df: DataFrame, keys: list[str], names: list[str], side: Column, crowded: DataFrame | None
) -> DataFrame:
    """Number the distinct rows of each key and side in the order of their md5.

    For crowded keys the order is cut into lanes by its leading digits. A row's number is
    the size of the lanes before its own plus its place inside the lane, so no task ever
    sorts a whole key of that kind. All other keys are one lane and need no sizes.
    """
    ordered = df.select(
        "*", _key_struct(keys).alias(_KEY), side.alias(_SIDE), F.md5(canonical_text(df, names)).alias(_ORDER)
    )
    in_lane = F.row_number().over(Window.partitionBy(_KEY, _SIDE, _LANE).orderBy(_ORDER))
    if crowded is None:
        # dealt out by key once: numbering and pairing both find a key's few rows together
        whole = F.row_number().over(Window.partitionBy(_KEY, _SIDE).orderBy(_ORDER))
        return ordered.repartition(F.col(_KEY)).withColumn(_RANK, whole)
    marked = ordered.join(crowded, F.col(_KEY) == F.col("__crowded"), "left")
    lane = F.when(F.col("__crowded").isNotNull(), F.substring(_ORDER, 1, _LANE_DIGITS)).otherwise(F.lit(""))
    laned = marked.withColumn(_LANE, lane).drop("__crowded")
    before = Window.partitionBy(_KEY, _SIDE).orderBy(_LANE).rowsBetween(
        Window.unboundedPreceding, -1
    )
    sizes = laned.where(F.col(_LANE) != "").groupBy(_KEY, _SIDE, _LANE).agg(F.count(F.lit(1)).alias("__size"))
    offsets = sizes.select(_KEY, _SIDE, _LANE, F.sum("__size").over(before).alias("__offset"))
    placed = laned.join(offsets, [_KEY, _SIDE, _LANE], "left")
    return placed.withColumn(_RANK, F.coalesce("__offset", F.lit(0)) + in_lane)
