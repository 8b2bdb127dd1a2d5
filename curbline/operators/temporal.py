"""Demand, duration and fare over time.

Counting and averaging operators accept cleaned trips or the stored
``temporal_hourly_stats`` table; the latter answers from a few thousand rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curbline.functions import columns as C
from curbline.functions import filters
from curbline.functions.rollup import mean_of, trips_in

DURATION_QUANTILES = {"p25": 0.25, "median": 0.5, "p75": 0.75, "p95": 0.95}
_TREND_KEYS = {
    "hour": {"hour": "pickup_hour"},
    "day": {"day_of_week": "pickup_day_of_week"},
    "month": {"year": "pickup_year", "month": "pickup_month"},
}


def _keyed(df: DataFrame, grain: str):
    return [F.col(source).alias(name) for name, source in _TREND_KEYS[grain].items()]


def trips_by_hour(df: DataFrame, year=None, month=None, day_of_week=None) -> DataFrame:
    df = filters.calendar(df, year, month, day_of_week)
    return df.groupBy(*_keyed(df, "hour")).agg(trips_in(df).alias("trip_count")).orderBy("hour")


def trips_by_day(df: DataFrame, year=None, month=None) -> DataFrame:
    df = filters.calendar(df, year, month)
    return df.groupBy(*_keyed(df, "day")).agg(trips_in(df).alias("trip_count")).orderBy("day_of_week")


def trips_by_month(df: DataFrame, year=None) -> DataFrame:
    df = filters.calendar(df, year)
    return df.groupBy(*_keyed(df, "month")).agg(trips_in(df).alias("trip_count")).orderBy("year", "month")


def peak_hours(df: DataFrame, top_n: int = 10) -> DataFrame:
    """Hours of day with the most trips; equal counts rank the earlier hour first."""
    counts = df.groupBy(*_keyed(df, "hour")).agg(trips_in(df).alias("trip_count"))
    return counts.orderBy(F.desc("trip_count"), "hour").limit(top_n)


def busiest_quietest(df: DataFrame) -> DataFrame:
    """One row: busiest and quietest hour of day and day of week, with counts.

    Only hours and days with trips compete; ties go to the smaller number.
    """
    cells = df.groupBy("pickup_hour", "pickup_day_of_week").agg(trips_in(df).alias("n"))
    # one tiny frame of (kind, number, trips), so trips are scanned once
    totals = (
        cells.select(
            F.explode(
                F.array(
                    F.struct(F.lit("hour").alias("kind"), F.col("pickup_hour").alias("number"), "n"),
                    F.struct(F.lit("day").alias("kind"), F.col("pickup_day_of_week").alias("number"), "n"),
                )
            ).alias("cell")
        )
        .groupBy("cell.kind", "cell.number")
        .agg(F.sum("cell.n").alias("n"))
    )

    def pick(kind: str, best, sign: int):
        # the largest count first, then the smallest number (negated)
        rank = F.struct((sign * F.col("n")).alias("n"), (-F.col("number")).alias("k"))
        return best(F.when(F.col("kind") == kind, rank))

    return totals.agg(
        pick("hour", F.max, 1).alias("busiest"),
        pick("hour", F.max, -1).alias("quietest"),
        pick("day", F.max, 1).alias("peak"),
        pick("day", F.max, -1).alias("lowest"),
    ).select(
        (-F.col("busiest.k")).alias("busiest_hour"),
        F.col("busiest.n").alias("busiest_hour_trips"),
        (-F.col("quietest.k")).alias("quietest_hour"),
        (-F.col("quietest.n")).alias("quietest_hour_trips"),
        (-F.col("peak.k")).alias("peak_day"),
        F.col("peak.n").alias("peak_day_trips"),
        (-F.col("lowest.k")).alias("lowest_day"),
        (-F.col("lowest.n")).alias("lowest_day_trips"),
    )


def duration_distribution(trips: DataFrame, year=None, month=None, accuracy: int | None = None) -> DataFrame:
    """One row: mean, sample stddev, min, max and quartiles (plus p95) of the duration."""
    minutes = "trip_duration_minutes"
    stats = filters.calendar(trips, year, month).agg(
        F.avg(minutes).alias("mean"),
        F.stddev(minutes).alias("stddev"),
        F.min(minutes).alias("min"),
        F.max(minutes).alias("max"),
        C.quantile(minutes, list(DURATION_QUANTILES.values()), accuracy).alias("q"),
    )
    return stats.select(
        "mean", "stddev", "min", "max", *[F.col("q")[i].alias(n) for i, n in enumerate(DURATION_QUANTILES)]
    )


def fare_trends(df: DataFrame, group_by: str = "month", year=None) -> DataFrame:
    """Mean fare and distance by ``hour``, ``day`` (of week) or ``month``."""
    df = filters.calendar(df, year)
    means = df.groupBy(*_keyed(df, group_by)).agg(
        mean_of(df, "fare_amount", "avg_fare").alias("avg_fare"),
        mean_of(df, "trip_distance", "avg_distance").alias("avg_distance"),
    )
    return means.orderBy(*_TREND_KEYS[group_by])


def hourly_slots(hourly: DataFrame, year=None, month=None, day_of_week=None, hour=None) -> DataFrame:
    """Rows of the ``temporal_hourly_stats`` table (or state) that match the filters."""
    return filters.calendar(hourly, year, month, day_of_week, hour)


def daily_counts(df: DataFrame, ts: str = C.PICKUP, start=None, end=None) -> DataFrame:
    """Rows per day key within an optional timestamp range."""
    ranged = filters.time_range(df, start, end, ts)
    return ranged.groupBy(C.day_key(ts).alias("date")).agg(F.count(F.lit(1)).alias("trip_count"))


def daily_trend(
    df: DataFrame, ts: str = C.PICKUP, start=None, end=None, rows: int = 7, days: int | None = None
) -> DataFrame:
    """Daily counts with the mean of the last ``rows`` present days.

    The window runs over one row per calendar day, never over trips. ``days``
    keeps only the first days, as a report limit.
    """
    daily = daily_counts(df, ts, start, end)
    trailing = Window.orderBy("date").rowsBetween(1 - rows, 0)
    trend = daily.withColumn("trend", F.avg("trip_count").over(trailing)).orderBy("date")
    return trend.limit(days) if days else trend


def seasonal_by_day(df: DataFrame, ts: str = C.PICKUP, start=None, end=None) -> DataFrame:
    """Mean daily count per day of week: the seasonal part of the decomposition."""
    daily = daily_counts(df, ts, start, end)
    return (
        daily.groupBy(F.dayofweek(F.to_date("date")).alias("day_of_week"))
        .agg(F.avg("trip_count").alias("avg_trips"), F.count(F.lit(1)).alias("day_count"))
        .orderBy("day_of_week")
    )


def decomposition(df: DataFrame, ts: str = C.PICKUP, start=None, end=None) -> DataFrame:
    """Daily count = trailing trend + day-of-week seasonal deviation + residual."""
    week = Window.partitionBy("day_of_week")
    everything = Window.partitionBy()
    trend = daily_trend(df, ts, start, end).withColumn("day_of_week", F.dayofweek(F.to_date("date")))
    seasonal = F.avg("trip_count").over(week) - F.avg("trip_count").over(everything)
    return (
        trend.withColumn("seasonal", seasonal)
        .withColumn("residual", F.col("trip_count") - F.col("trend") - F.col("seasonal"))
        .orderBy("date")
    )
