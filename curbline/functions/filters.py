"""Optional-argument predicates. ``None`` always means "no restriction"."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline.functions.columns import PICKUP


def _first_present(df: DataFrame, *names: str) -> Column:
    for name in names:
        if name in df.columns:
            return F.col(name)
    raise ValueError(f"none of the columns {names} is present")


def calendar(df: DataFrame, year=None, month=None, day_of_week=None, hour=None) -> DataFrame:
    """Restrict by calendar fields.

    Year and month go to the ``year``/``month`` partition columns when the frame
    has them, so that a stored table is pruned by directory. ``day_of_week`` may
    be one day or a list of days (Sunday = 1).
    """
    if year is not None:
        df = df.where(_first_present(df, "year", "pickup_year") == int(year))
    if month is not None:
        df = df.where(_first_present(df, "month", "pickup_month") == int(month))
    if day_of_week is not None:
        days = day_of_week if isinstance(day_of_week, (list, tuple, set)) else [day_of_week]
        if days:
            df = df.where(F.col("pickup_day_of_week").isin(*[int(d) for d in days]))
    if hour is not None:
        df = df.where(F.col("pickup_hour") == int(hour))
    return df


def between(df: DataFrame, column: str, low=None, high=None) -> DataFrame:
    """Closed range on one column."""
    if low is not None:
        df = df.where(F.col(column) >= F.lit(low))
    if high is not None:
        df = df.where(F.col(column) <= F.lit(high))
    return df


def explorer(
    df: DataFrame,
    year=None,
    month=None,
    payment_type=None,
    min_fare=None,
    max_fare=None,
    min_distance=None,
    max_distance=None,
    min_passengers=None,
    max_passengers=None,
) -> DataFrame:
    """The explorer's row filters, all inclusive."""
    df = calendar(df, year, month)
    if payment_type is not None:
        df = df.where(F.col("payment_type") == int(payment_type))
    df = between(df, "fare_amount", min_fare, max_fare)
    df = between(df, "trip_distance", min_distance, max_distance)
    return between(df, "passenger_count", min_passengers, max_passengers)


def time_range(df: DataFrame, start: str | None = None, end: str | None = None, column: str = PICKUP) -> DataFrame:
    """Closed timestamp range with text bounds."""
    kind = df.schema[column].dataType.simpleString()
    low = F.lit(start).cast(kind) if start is not None else None
    high = F.lit(end).cast(kind) if end is not None else None
    return between(df, column, low, high)


def trainable(df: DataFrame) -> DataFrame:
    """Rows a fare model can learn from."""
    ends = ["pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude"]
    return df.where((F.col("fare_amount") > 0) & (F.col("trip_distance") > 0)).dropna(subset=ends)
