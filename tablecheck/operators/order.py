"""Rows in a total order, without a task that sees them all.

Equal rows are folded into one row with a count before anything is cut by range, so a row
repeated a billion times is one row in one range, and is dealt out again afterwards.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablecheck.functions.names import column
from tablecheck.sources.scratch import staged

#: Copies of one row that a task writes out at once.
CHUNK = 65_536

COPIES, RANGE, BEFORE = "__copies", "__range", "__before"
_CHUNK, _COPY = "__chunk", "__copy"


def folded(df: DataFrame) -> DataFrame:
    """Distinct rows with their number of copies, combined before the shuffle."""
    return df.groupBy(*map(column, df.columns)).agg(F.count(F.lit(1)).alias(COPIES))


def expanded(df: DataFrame, copies: Column, position: str | None = None) -> DataFrame:
    """Every row ``copies`` times over, without the columns used to count them.

    More than ``CHUNK`` copies are cut into chunks that are dealt out over all tasks.
    ``position`` names a column for the number of each copy, counted from ``BEFORE``.
    """
    own = [column(c) for c in df.columns if c not in (COPIES, RANGE, BEFORE)]
    before = [F.col(BEFORE)] if position else []
    counted = df.select(*own, *before, copies.cast("bigint").alias(COPIES)).where(F.col(COPIES) > 0)
    few = counted.where(F.col(COPIES) <= CHUNK).withColumn(_CHUNK, F.lit(0).cast("bigint"))
    chunks = F.floor((F.col(COPIES) - 1) / F.lit(CHUNK)).cast("bigint")
    many = counted.where(F.col(COPIES) > CHUNK).withColumn(_CHUNK, F.explode(F.sequence(F.lit(0).cast("bigint"), chunks)))
    first = F.col(_CHUNK) * CHUNK
    last = F.least(first + CHUNK, F.col(COPIES)) - 1
    numbered = [F.lit(1).cast("bigint") + F.col(BEFORE) + F.col(_COPY)] if position else []
    # a number of its own: chunks are few bytes that adaptive execution would put back together
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = [
        part.withColumn(_COPY, F.explode(F.sequence(first, last))).select(*own, *[n.alias(position) for n in numbered])
        for part in (few, many.repartition(tasks, _CHUNK, *own))
    ]
    return reduce(DataFrame.unionAll, parts)


def ranged(df: DataFrame, by: list[Column], purpose: str, parts: int | None = None) -> DataFrame:
    """``df`` cut into ranges of ``by``, written once, each row with the number of its range."""
    cut = df.repartitionByRange(*([parts] if parts else []), *by)
    return staged(cut.withColumn(RANGE, F.spark_partition_id()), purpose)


def before_in_range(by: list[Column]) -> Column:
    """How many copies of earlier rows the range of a folded row holds."""
    whole = Window.partitionBy(RANGE).orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(COPIES).over(whole), F.lit(0).cast("bigint"))


def with_position(df: DataFrame, by: list[Column | str], name: str = "position") -> DataFrame:
    """``df`` with the place of every row in the order of ``by``, counted from 1.

    Rows equal in ``by`` follow in the order of their other columns, in which they must be
    sortable; NULLs come first unless ``by`` says otherwise. The rows are cut into ranges and
    written once, each range is numbered by itself, and what reaches the driver is one
    number of rows per range.
    """
    if name in df.columns:
        raise ValueError(f"there is a column {name!r} already")
    order = [column(b) if isinstance(b, str) else b for b in by]
    order += [column(c) for c in df.columns]
    held = ranged(folded(df), order, "ordered")
    sizes = sorted(held.groupBy(RANGE).agg(F.sum(COPIES)).collect())
    starts, seen = [], 0
    for number, size in sizes:
        starts.append((number, seen))
        seen += size
    offsets = df.sparkSession.createDataFrame(starts, f"{RANGE} int, __offset bigint")
    placed = held.withColumn("__inside", before_in_range(order)).join(offsets, RANGE)
    placed = placed.withColumn(BEFORE, F.col("__inside") + F.col("__offset")).drop("__inside", "__offset")
    return expanded(placed, F.col(COPIES), name)
