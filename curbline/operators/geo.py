"""Hotspots, routes, density and airports.

Every top-n ends in ``orderBy(...).limit(n)`` with the group keys as
tie-breakers: each task keeps n rows and only those travel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline import schema as S
from curbline.functions import columns as C
from curbline.functions import filters
from curbline.functions.airports import airport_named, in_box
from curbline.functions.rollup import mean_of, trips_in

ROUTE_KEYS = ["pickup_lat_grid", "pickup_lon_grid", "dropoff_lat_grid", "dropoff_lon_grid"]


def hotspots(df: DataFrame, side: str = "pickup", top_n: int = 20, min_trips: int = 100) -> DataFrame:
    """Grid cells with the most pickups or dropoffs (trips or zone table)."""
    cell = [F.col(f"{side}_lat_grid").alias("latitude"), F.col(f"{side}_lon_grid").alias("longitude")]
    counts = df.groupBy(*cell).agg(trips_in(df).alias("trip_count")).where(F.col("trip_count") >= min_trips)
    return counts.orderBy(F.desc("trip_count"), "latitude", "longitude").limit(top_n)


def pickup_hotspots(df: DataFrame, top_n: int = 20, min_trips: int = 100) -> DataFrame:
    return hotspots(df, "pickup", top_n, min_trips)


def dropoff_hotspots(df: DataFrame, top_n: int = 20, min_trips: int = 100) -> DataFrame:
    return hotspots(df, "dropoff", top_n, min_trips)


def route_pairs(df: DataFrame, top_n: int = 20, by_month: bool = False) -> DataFrame:
    """Most frequent routes, over all months or per (route, month).

    On the stored route table the answer is exact only if the table keeps every
    route; build it with ``min_trips=1`` (the stored state always does).
    """
    keys = ROUTE_KEYS + (["pickup_year", "pickup_month"] if by_month else [])
    routes = df.groupBy(*keys).agg(
        trips_in(df).alias("trip_count"),
        mean_of(df, "fare_amount", "avg_fare").alias("avg_fare"),
        mean_of(df, "trip_distance", "avg_distance").alias("avg_distance"),
    )
    top = routes.orderBy(F.desc("trip_count"), *keys).limit(top_n)
    return top.select(
        C.route_point("pickup_lat_grid", "pickup_lon_grid").alias("pickup"),
        C.route_point("dropoff_lat_grid", "dropoff_lon_grid").alias("dropoff"),
        *(["pickup_year", "pickup_month"] if by_month else []),
        "trip_count",
        "avg_fare",
        "avg_distance",
    )


def spatial_density(
    trips: DataFrame, grid_size: float = 0.01, above: int = 10, top_n: int = 100
) -> DataFrame:
    """Densest pickup cells of a grid of any size, keyed by integer cell number."""
    cells = trips.groupBy(
        C.grid_index("pickup_latitude", grid_size).alias("lat_cell"),
        C.grid_index("pickup_longitude", grid_size).alias("lon_cell"),
    ).agg(F.count(F.lit(1)).alias("density"))
    top = cells.where(F.col("density") > above).orderBy(F.desc("density"), "lat_cell", "lon_cell").limit(top_n)
    return top.select(
        C.grid_centre("lat_cell", grid_size).alias("latitude"),
        C.grid_centre("lon_cell", grid_size).alias("longitude"),
        "density",
    )


def zone_query(
    zones: DataFrame, year: int, month: int, hour_bucket: str | None = None, min_trips: int = 10
) -> DataFrame:
    """Rows of the zone table (or state) for one month."""
    zones = filters.calendar(zones, year, month).where(F.col("trip_count") >= int(min_trips))
    return zones if hour_bucket is None else zones.where(F.col("hour_bucket") == hour_bucket)


def _airport_measures(trips: DataFrame, airports, half_width, city_row: bool) -> DataFrame:
    """Per airport: trips picked up in its box. One scan; boxes may overlap.

    An airport without trips keeps its row, with a count of 0.
    """
    measures = {"avg_fare": "fare_amount", "avg_distance": "trip_distance", "avg_duration": "trip_duration_minutes"}

    def one(name, inside):
        n = F.count(F.lit(1)) if inside is None else F.count_if(inside)
        means = [
            F.avg(c if inside is None else F.when(inside, F.col(c))).alias(out) for out, c in measures.items()
        ]
        return F.struct(F.lit(name).alias("zone"), n.alias("trip_count"), *means)

    zones = [one(a, in_box("pickup_latitude", "pickup_longitude", airport_named(a), half_width)) for a in airports]
    if city_row:
        zones.append(one("city", None))
    return trips.agg(F.array(*zones).alias("zones")).select(F.inline("zones"))


def airport_compare(
    trips: DataFrame, airports=S.COMPARED_AIRPORTS, half_width: float | None = S.COMPARED_HALF_WIDTH
) -> DataFrame:
    """Pickups at each airport: count, mean fare, distance and duration."""
    return _airport_measures(trips, airports, half_width, city_row=False)


def zone_comparison(
    trips: DataFrame, airports=S.COMPARED_AIRPORTS, half_width: float | None = S.COMPARED_HALF_WIDTH
) -> DataFrame:
    """``airport_compare`` plus a ``city`` row over all trips."""
    return _airport_measures(trips, airports, half_width, city_row=True)
