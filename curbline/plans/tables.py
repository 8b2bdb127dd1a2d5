"""The seven aggregate tables, built from cleaned trips.

Each is one grouped aggregation whose partial step runs before the shuffle, so
what travels is groups, not trips, and a group holding a third of all trips is
combined like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline import schema as S
from curbline.functions import columns as C
from curbline.functions.airports import airport_trips
from curbline.functions.rollup import percent_of
from curbline.operators.geo import ROUTE_KEYS

HOURLY_KEYS = ["pickup_year", "pickup_month", "pickup_day_of_week", "pickup_hour"]
ZONE_KEYS = ROUTE_KEYS + ["pickup_year", "pickup_month", "hour_bucket"]
ROUTE_MONTH_KEYS = ROUTE_KEYS + ["pickup_year", "pickup_month"]
FARE_KEYS = ["distance_bucket", "duration_bucket", "pickup_hour", "pickup_day_of_week", "payment_type"]
TIP_KEYS = ["payment_type", "pickup_hour", "distance_bucket", "passenger_count"]
AIRPORT_KEYS = ["airport_name", "direction"] + HOURLY_KEYS

MIN_ROUTE_TRIPS = 100
HIGH_TIP_SHARE = 0.25


def _trip_means():
    return [
        F.count(F.lit(1)).alias("trip_count"),
        F.avg("fare_amount").alias("avg_fare"),
        F.avg("trip_distance").alias("avg_distance"),
        F.avg("trip_duration_minutes").alias("avg_duration"),
    ]


def temporal_hourly_stats(trips: DataFrame, accuracy: int | None = None) -> DataFrame:
    return trips.groupBy(*HOURLY_KEYS).agg(
        *_trip_means(),
        F.sum("fare_amount").alias("total_revenue"),
        F.avg("tip_amount").alias("avg_tip"),
        F.avg("passenger_count").alias("avg_passenger_count"),
        C.quantile("fare_amount", 0.5, accuracy).alias("median_fare"),
        C.quantile("trip_distance", 0.5, accuracy).alias("median_distance"),
    )


def geospatial_zone_stats(trips: DataFrame) -> DataFrame:
    return trips.withColumn("hour_bucket", C.hour_bucket()).groupBy(*ZONE_KEYS).agg(*_trip_means())


def route_pairs_top(trips: DataFrame, min_trips: int = MIN_ROUTE_TRIPS) -> DataFrame:
    """Routes per month with at least ``min_trips`` trips in that month."""
    weekend = C.is_weekend()
    routes = trips.groupBy(*ROUTE_MONTH_KEYS).agg(
        *_trip_means(),
        F.count_if(weekend).alias("trip_count_weekend"),
        F.count_if(~weekend).alias("trip_count_weekday"),
    )
    return routes.where(F.col("trip_count") >= min_trips)


def economic_fare_analysis(trips: DataFrame) -> DataFrame:
    """Ratios are ratios of means (all tips over all fares, and so on)."""
    bucketed = trips.withColumns(
        {
            "distance_bucket": C.bucket("trip_distance", *S.DISTANCE_5WAY),
            "duration_bucket": C.bucket("trip_duration_minutes", *S.DURATION_4WAY),
        }
    )
    avg_fare, avg_tip = F.avg("fare_amount"), F.avg("tip_amount")
    return bucketed.groupBy(*FARE_KEYS).agg(
        F.count(F.lit(1)).alias("trip_count"),
        avg_fare.alias("avg_fare"),
        avg_tip.alias("avg_tip"),
        percent_of(avg_tip, avg_fare).alias("tip_percentage"),
        F.sum("fare_amount").alias("total_revenue"),
        F.try_divide(avg_fare, F.avg("trip_distance")).alias("fare_per_mile"),
        F.try_divide(avg_fare, F.avg("trip_duration_minutes")).alias("fare_per_minute"),
    )


def _tip_rates():
    n = F.count(F.lit(1))
    high = F.count_if(F.try_divide(F.col("tip_amount"), F.col("fare_amount")) > HIGH_TIP_SHARE)
    return [
        n.alias("trip_count"),
        F.avg("tip_amount").alias("avg_tip"),
        percent_of(F.avg("tip_amount"), F.avg("fare_amount")).alias("tip_percentage"),
        percent_of(high, n).alias("high_tipper_rate"),
        percent_of(F.count_if(F.col("tip_amount") == 0), n).alias("no_tip_rate"),
    ]


def tip_behavior_rates(trips: DataFrame, keys=TIP_KEYS, scheme=S.DISTANCE_3WAY) -> DataFrame:
    """Tip measures on any keys and distance scheme, without the median."""
    return trips.withColumn("distance_bucket", C.bucket("trip_distance", *scheme)).groupBy(*keys).agg(*_tip_rates())


def tip_behavior_analysis(trips: DataFrame, accuracy: int | None = None) -> DataFrame:
    bucketed = trips.withColumn("distance_bucket", C.bucket("trip_distance", *S.DISTANCE_3WAY))
    median = C.quantile("tip_amount", 0.5, accuracy).alias("median_tip")
    return bucketed.groupBy(*TIP_KEYS).agg(*_tip_rates(), median)


def airport_analysis(trips: DataFrame) -> DataFrame:
    return airport_trips(trips).groupBy(*AIRPORT_KEYS).agg(*_trip_means())


def summary_stats(trips: DataFrame) -> DataFrame:
    """One row over the whole dataset."""
    spread = {"fare": "fare_amount", "distance": "trip_distance", "duration": "trip_duration_minutes"}
    plain = {"tip": "tip_amount", "passengers": "passenger_count"}
    measures = []
    for name, column in {**spread, **plain}.items():
        measures += [
            F.avg(column).alias(f"avg_{name}"),
            F.min(column).alias(f"min_{name}"),
            F.max(column).alias(f"max_{name}"),
        ]
    row = trips.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.min(C.PICKUP).alias("min_date"),
        F.max(C.PICKUP).alias("max_date"),
        F.sum("fare_amount").alias("total_revenue"),
        *measures,
        *[F.stddev(column).alias(f"stddev_{name}") for name, column in spread.items()],
    )
    return with_summary_ratios(row)


def with_summary_ratios(row: DataFrame) -> DataFrame:
    return row.withColumns(
        {
            "avg_fare_per_mile": F.when(F.col("avg_distance") > 0, F.col("avg_fare") / F.col("avg_distance")),
            "avg_tip_rate": F.when(F.col("avg_fare") > 0, F.col("avg_tip") / F.col("avg_fare") * 100),
        }
    )


BUILDERS = {
    "temporal_hourly_stats": temporal_hourly_stats,
    "geospatial_zone_stats": geospatial_zone_stats,
    "route_pairs_top": route_pairs_top,
    "economic_fare_analysis": economic_fare_analysis,
    "tip_behavior_analysis": tip_behavior_analysis,
    "airport_analysis": airport_analysis,
    "summary_stats": summary_stats,
}


def build_all(trips: DataFrame, out_dir: str, route_min_trips: int = MIN_ROUTE_TRIPS) -> dict[str, str]:
    """Write every table as Parquet; returns name -> path.

    Each build scans only the columns it uses. The trips are not persisted: at
    full size a column-pruned scan is cheaper than spilling a cached copy.
    """
    paths = {}
    for name, build in BUILDERS.items():
        table = build(trips, min_trips=route_min_trips) if name == "route_pairs_top" else build(trips)
        paths[name] = f"{out_dir.rstrip('/')}/{name}"
        table.write.mode("overwrite").parquet(paths[name])
    return paths
