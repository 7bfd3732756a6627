"""A comparable pair: the same sampled keys cut out of both tables."""

from __future__ import annotations

import math
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecheck.functions.flags import all_of, any_null
from tablecheck.functions.names import column, trimmed_names
from tablecheck.operators.order import COPIES, RANGE, before_in_range, expanded, folded, ranged
from tablecheck.sources.scratch import staged

# A range that has to be cut in two is first split until it holds about this many rows.
RANGE_ROWS = 1_000_000


class SampledPair(NamedTuple):
    keys: DataFrame
    a: DataFrame
    b: DataFrame


def normalize_columns(df: DataFrame) -> DataFrame:
    """Trim blanks from the column names."""
    return df.toDF(*trimmed_names(df.columns))


def sample_keys(df: DataFrame, keys: list[str], limit: int) -> DataFrame:
    """The first ``limit`` distinct keys in key order. NULL keys match nothing: left out."""
    by_key = [column(k) for k in keys]
    return first_rows(df.where(~any_null(keys)).select(*by_key), by_key, limit, distinct=True)


def first_rows(df: DataFrame, by: list[Column], limit: int, distinct: bool = False) -> DataFrame:
    """The first ``limit`` rows in the order of ``by``, which has all columns.

    Equal rows are folded into one with a count first (``distinct`` makes that count one).
    The folded rows are range-partitioned and written once. Whole ranges are taken as they
    are; only the one range that holds the last row is cut, after being split further while
    it is large, which it can be, as no two of its rows are equal. The limit is taken on
    running counts, and the copies are dealt out again at the end. What reaches the driver
    is one count per range.
    """
    taken: list[DataFrame] = []
    rest, left, parts = folded(df), limit, None
    if distinct:
        rest = rest.withColumn(COPIES, F.lit(1).cast("bigint"))
    while True:
        cut = ranged(rest, by, "ranges", parts)
        counted = cut.groupBy(RANGE).agg(F.sum(COPIES).alias("copies"), F.count(F.lit(1)).alias("rows"))
        sizes = {r[RANGE]: (r["copies"], r["rows"]) for r in counted.collect()}
        whole = sum(rows for _, rows in sizes.values())
        if sum(copies for copies, _ in sizes.values()) <= left:
            taken.append(cut.drop(RANGE))
            break
        for last in sorted(sizes):
            if sizes[last][0] > left:
                break
            left -= sizes[last][0]
        taken.append(cut.where(F.col(RANGE) < last).drop(RANGE))
        rest = cut.where(F.col(RANGE) == last)
        _, rows = sizes[last]
        if rows <= RANGE_ROWS or (parts and rows == whole):
            fits = F.least(F.col(COPIES), F.lit(left).cast("bigint") - before_in_range(by))
            rest = rest.withColumn("__fits", fits).where("__fits > 0")
            taken.append(rest.withColumn(COPIES, F.col("__fits")).drop("__fits", RANGE))
            break
        rest, parts = rest.drop(RANGE), max(2, math.ceil(rows / RANGE_ROWS))
    return expanded(reduce(DataFrame.unionByName, taken), F.col(COPIES))


def lowest_rows(df: DataFrame, keys: list[str], limit: int) -> DataFrame:
    """The first ``limit`` rows by key and then by the other columns."""
    rest = [c for c in df.columns if c not in keys]
    return first_rows(df, [column(c) for c in [*keys, *rest]], limit)


def rows_of_keys(df: DataFrame, sample: DataFrame) -> DataFrame:
    """Rows of ``df`` whose key is in ``sample``.

    ``sample`` is a written table, so Spark knows its size and broadcasts it when it is
    under the session's threshold; a larger one is joined by shuffle.
    """
    names = sample.columns
    wanted = sample.toDF(*[f"__key{i}" for i in range(len(names))])
    same = all_of(column(c) == F.col(f"__key{i}") for i, c in enumerate(names))
    return df.join(wanted, same, "left_semi")


def sample_pair(
    a: DataFrame, b: DataFrame, keys: list[str], limit: int, row_limit: int | None = None
) -> SampledPair:
    """Sample ``limit`` keys of A and return both tables cut to exactly those keys.

    The keys are written once to shared scratch space and read back, so both cuts see
    the same ones. ``row_limit`` optionally caps each cut, lowest rows first.
    """
    a, b = normalize_columns(a), normalize_columns(b)
    sample = staged(sample_keys(a, keys, limit), "sample-keys")
    cuts = [rows_of_keys(side, sample) for side in (a, b)]
    if row_limit is not None:
        cuts = [lowest_rows(cut, keys, row_limit) for cut in cuts]
    return SampledPair(sample, *cuts)
