"""When and where demand runs high, what it earns, and which routes are slow.

These operators take the stored aggregate tables: hours, zones, routes, fares.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curbline.functions import columns as C
from curbline.operators.geo import ROUTE_KEYS
from curbline.plans.tables import HOURLY_KEYS, ZONE_KEYS

MONTH_KEYS = ["pickup_year", "pickup_month"]


def demand_surge(hourly: DataFrame, threshold: float = 1.5) -> DataFrame:
    """Hours with far more trips than the mean hour of the same month and weekday.

    z = (trips - mean) / sample deviation; a deviation of 0 counts as 1. A lone
    hour has no deviation and is never a surge.
    """
    same_days = Window.partitionBy("pickup_year", "pickup_month", "pickup_day_of_week")
    std = F.stddev("trip_count").over(same_days)
    scored = hourly.select(
        *HOURLY_KEYS, "trip_count", F.avg("trip_count").over(same_days).alias("mean"), std.alias("std")
    )
    divisor = F.when(F.col("std") == 0, F.lit(1.0)).otherwise(F.col("std"))
    scored = scored.withColumn("z_score", (F.col("trip_count") - F.col("mean")) / divisor)
    return scored.where(F.col("z_score") > threshold).orderBy(F.desc("z_score"), *HOURLY_KEYS)


def hot_zones(zones: DataFrame, surge: DataFrame, top_n: int = 100) -> DataFrame:
    """Busiest zone rows of the months that have surge hours, once per surge hour.

    The order starts with the zone row, and each repeats at least once, so the
    first ``top_n`` results come from the first ``top_n`` zone rows. Those are
    picked before the many-to-many join, which then stays small.
    """
    hours = surge.select(*HOURLY_KEYS)
    order = [F.desc("trip_count"), *ZONE_KEYS]
    leading = zones.join(hours.select(*MONTH_KEYS).distinct(), MONTH_KEYS, "left_semi").orderBy(*order).limit(top_n)
    repeated = leading.join(hours, MONTH_KEYS)
    return repeated.orderBy(*order, "pickup_day_of_week", "pickup_hour").limit(top_n)


def revenue_windows(fares: DataFrame, top_n: int = 48) -> DataFrame:
    """Day-of-week and hour slots by total revenue."""
    slots = fares.groupBy("pickup_day_of_week", "pickup_hour").agg(F.sum("total_revenue").alias("total_revenue"))
    return slots.orderBy(F.desc("total_revenue"), "pickup_day_of_week", "pickup_hour").limit(top_n)


def inefficient_routes(routes: DataFrame, above: int = 200, top_n: int = 50) -> DataFrame:
    """Routes with more than ``above`` trips by minutes per mile, slowest first."""
    slow = routes.where(F.col("trip_count") > above).withColumn(
        "minutes_per_mile", F.col("avg_duration") / C.at_least("avg_distance", 0.1)
    )
    tie = [c for c in ROUTE_KEYS + MONTH_KEYS if c in routes.columns]
    return slow.orderBy(F.desc("minutes_per_mile"), *tie).limit(top_n)


def ordinal_slots(hourly: DataFrame) -> DataFrame:
    """Hourly rows numbered in slot order (year, month, weekday, hour), from 0.

    One row per stored slot, a few thousand in all, goes through the window.
    This order is not chronological; forecasts use ``forecast.hourly_demand``.
    """
    order = Window.orderBy(*HOURLY_KEYS)
    return hourly.select(
        (F.row_number().over(order) - 1).alias("time_index"), *HOURLY_KEYS, "trip_count"
    ).orderBy("time_index")
