"""Conversion rates of an experiment, overall and by day.

Input: ``experiment_id, variation, user_id, conversion, time_on_site, date``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_GROUP = ["experiment_id", "variation"]


def _rate(conversions: Column, users: Column) -> Column:
    return F.try_divide(conversions.cast("double"), users.cast("double"))


def _summary(exposures: DataFrame, keys: list[str], prefixes: tuple[str, str, str, str]) -> DataFrame:
    users, conversions, time, rate = prefixes
    counted = exposures.groupBy(*keys).agg(
        F.count("user_id").alias(users),
        F.sum("conversion").alias(conversions),
        F.avg("time_on_site").alias(time),
    )
    return counted.withColumn(rate, _rate(F.col(conversions), F.col(users)))


def conversion_summary(exposures: DataFrame) -> DataFrame:
    """Users, conversions, average time and rate by experiment and variation."""
    return _summary(
        exposures, _GROUP,
        ("total_users", "total_conversions", "avg_time_on_site", "conversion_rate"),
    )


def conversion_daily(exposures: DataFrame) -> DataFrame:
    """The same by experiment, variation and date."""
    return _summary(
        exposures, [*_GROUP, "date"],
        ("daily_users", "daily_conversions", "daily_avg_time_on_site", "daily_conversion_rate"),
    )


def conversion_report(exposures: DataFrame) -> DataFrame:
    """Daily rows with the overall numbers of their variation, in report order.

    The exposures are read and shuffled once: the overall numbers add up the daily
    sums and counts, so only one row per day and variation reaches the window.
    """
    daily = (
        exposures.where(F.col("experiment_id").isNotNull() & F.col("variation").isNotNull())
        .groupBy(*_GROUP, "date")
        .agg(
            F.count("user_id").alias("daily_users"),
            F.sum("conversion").alias("daily_conversions"),
            F.sum(F.col("time_on_site").cast("double")).alias("time"),
            F.count("time_on_site").alias("timed"),
        )
    )
    whole = Window.partitionBy(*_GROUP)
    overall = {
        "total_users": F.sum("daily_users").over(whole),
        "total_conversions": F.sum("daily_conversions").over(whole),
        "avg_time_on_site": F.try_divide(F.sum("time").over(whole), F.sum("timed").over(whole)),
    }
    return (
        daily.select("*", *[v.alias(k) for k, v in overall.items()])
        .select(
            *_GROUP,
            *overall,
            _rate(F.col("total_conversions"), F.col("total_users")).alias("conversion_rate"),
            "date",
            "daily_users",
            "daily_conversions",
            F.try_divide(F.col("time"), F.col("timed")).alias("daily_avg_time_on_site"),
            _rate(F.col("daily_conversions"), F.col("daily_users")).alias("daily_conversion_rate"),
        )
        .orderBy(*_GROUP, "date")
    )
