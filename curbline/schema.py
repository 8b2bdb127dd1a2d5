"""The trip data model: schemas, cleaning limits, airport boxes, bucket edges."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_INT, _DBL, _STR, _TS = IntegerType(), DoubleType(), StringType(), TimestampType()

# Column names and types of the vendor CSV files, in file order.
TRIP_SCHEMA = StructType(
    [
        StructField("VendorID", _INT),
        StructField("tpep_pickup_datetime", _TS),
        StructField("tpep_dropoff_datetime", _TS),
        StructField("passenger_count", _INT),
        StructField("trip_distance", _DBL),
        StructField("pickup_longitude", _DBL),
        StructField("pickup_latitude", _DBL),
        StructField("RateCodeID", _INT),
        StructField("store_and_fwd_flag", _STR),
        StructField("dropoff_longitude", _DBL),
        StructField("dropoff_latitude", _DBL),
        StructField("payment_type", _INT),
        StructField("fare_amount", _DBL),
        StructField("extra", _DBL),
        StructField("mta_tax", _DBL),
        StructField("tip_amount", _DBL),
        StructField("tolls_amount", _DBL),
        StructField("improvement_surcharge", _DBL),
        StructField("total_amount", _DBL),
    ]
)

DERIVED_FIELDS = [
    StructField("trip_duration_minutes", _DBL),
    StructField("pickup_lat_grid", _DBL),
    StructField("pickup_lon_grid", _DBL),
    StructField("dropoff_lat_grid", _DBL),
    StructField("dropoff_lon_grid", _DBL),
    StructField("pickup_hour", _INT),
    StructField("pickup_day_of_week", _INT),
    StructField("pickup_month", _INT),
    StructField("pickup_year", _INT),
]

PARTITION_FIELDS = [
    StructField("year", _INT),
    StructField("month", _INT),
    StructField("load_id", _STR),
]

CLEANED_SCHEMA = StructType(list(TRIP_SCHEMA.fields) + DERIVED_FIELDS + PARTITION_FIELDS)

# Cleaning limits. Duration (minutes), distance (miles) and fare
# (dollars) are open intervals; passengers and coordinates are closed ones.
CLEANING_LIMITS = {
    "trip_duration_min": 1,
    "trip_duration_max": 180,
    "trip_distance_min": 0.1,
    "trip_distance_max": 100,
    "fare_amount_min": 2.50,
    "fare_amount_max": 500,
    "passenger_count_min": 1,
    "passenger_count_max": 6,
    "lat_min": 40.5,
    "lat_max": 40.9,
    "lon_min": -74.3,
    "lon_max": -73.7,
}

# Airport centres and radii; a box reaches radius * 0.02 degrees
# to each side, and the first match in this order names the airport.
AIRPORTS = [
    {"name": "JFK", "lat": 40.6413, "lon": -73.7781, "radius_miles": 2.0},
    {"name": "LGA", "lat": 40.7769, "lon": -73.8730, "radius_miles": 1.5},
    {"name": "EWR", "lat": 40.6895, "lon": -74.1745, "radius_miles": 2.0},
]
DEGREES_PER_RADIUS_MILE = 0.02
COMPARED_AIRPORTS = ("JFK", "LGA")
COMPARED_HALF_WIDTH = 0.05

# Bucket edges (value < edge) and their labels, one more than edges.
DISTANCE_5WAY = ([1, 3, 5, 10], ["0-1mi", "1-3mi", "3-5mi", "5-10mi", "10+mi"])
DISTANCE_4WAY = (
    [2, 5, 10],
    ["Short (<2 mi)", "Medium (2-5 mi)", "Long (5-10 mi)", "Very Long (>10 mi)"],
)
DISTANCE_3WAY = ([2, 5], ["short", "medium", "long"])
DISTANCE_3WAY_TITLES = ([2, 5], ["Short (<2 mi)", "Medium (2-5 mi)", "Long (>5 mi)"])
DURATION_4WAY = ([10, 20, 40], ["0-10min", "10-20min", "20-40min", "40+min"])
HOUR_BUCKETS = [("morning", 6, 11), ("afternoon", 12, 17), ("evening", 18, 22)]
HOUR_BUCKET_REST = "night"

# Every edge of the distance schemes above. Stored state is kept in these bands
# so that each scheme is an exact union of them.
DISTANCE_BAND_EDGES = [1, 2, 3, 5, 10]

WEEKEND_DAYS = (1, 7)  # Sunday = 1 ... Saturday = 7
CARD, CASH = 1, 2
EARTH_RADIUS_MILES = 3959
