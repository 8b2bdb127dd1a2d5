"""Measures that work on trips and on stored aggregates alike.

A frame with a ``trip_count`` column holds groups of trips; without one, each
row is a trip. Means over groups are weighted by the group's trip count, so
both give the same answer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_aggregate(df: DataFrame) -> bool:
    return "trip_count" in df.columns


def trips_in(df: DataFrame) -> Column:
    return F.sum("trip_count") if is_aggregate(df) else F.count(F.lit(1))


def mean_of(df: DataFrame, trip_column: str, group_mean: str) -> Column:
    if not is_aggregate(df):
        return F.avg(trip_column)
    return F.try_divide(F.sum(F.col(group_mean) * F.col("trip_count")), F.sum("trip_count"))


def percent_of(part: Column, whole: Column) -> Column:
    """100 * part / whole, NULL when the whole is zero or NULL."""
    return F.try_divide(part, whole) * F.lit(100)
