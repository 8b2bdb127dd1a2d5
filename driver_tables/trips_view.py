"""Each ``lineitem`` row seen as one raw trip, by integer arithmetic.

The formulas (FIXTURES.md, section 2) are chosen so that Spark and DuckDB agree
to the bit, every cleaning limit is crossed and no coordinate meets a rounding
tie. ``TRIPS_SQL`` is the same view for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from curbline import schema as S
from curbline.operators.clean import clean_trips
from curbline.session import use_utc

ROW_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _div(a: str, m: int) -> str:
    return f"(({a}) div {m})"


def raw_trips(spark: SparkSession, sf_dir: str, with_key: bool = False) -> DataFrame:
    """Raw trips in ``TRIP_SCHEMA``, optionally led by the row key."""
    base = table(spark, sf_dir, "lineitem").selectExpr(
        "*",
        "(l_orderkey * 7919 + l_partkey * 104729 + l_linenumber * 1299709L + l_suppkey * 15485863) % 1000003 AS h",
    )
    step = base.selectExpr(
        *ROW_KEY,
        "l_quantity",
        "l_returnflag",
        "l_shipdate",
        "h",
        "h % 86400 AS s",
        "(h * 31 + 7) % 1100 AS x",
        "(h * 17 + 3) % 12000 AS du",
        "(h * 13 + 5) % 10 AS z",
        "(h * 37 + 11) % 5000 AS a1",
        "(h * 41 + 13) % 7000 AS o1",
        "(h * 43 + 17) % 5000 AS a2",
        "(h * 47 + 19) % 7000 AS o2",
        "1 + l_orderkey % 4 AS pt",
    )
    cents = step.selectExpr(
        "*",
        f"{_div('s * s', 86400)} AS sec",
        f"{_div('x * x', 100)} AS dh",
        f"200 + 2 * {_div('x * x', 100)} + h % 700 + IF(h % 997 = 0, 50000, 0) AS fc",
    ).selectExpr(
        "*",
        "CASE WHEN l_returnflag = 'A' AND l_linenumber = 1 THEN NULL"
        f" WHEN pt = 1 THEN {_div('fc * (h % 31)', 100)} ELSE 0 END AS tc",
    )
    values = {
        "VendorID": "1 + l_suppkey % 2",
        "tpep_pickup_datetime": "timestamp_seconds(unix_timestamp(l_shipdate) + sec)",
        "tpep_dropoff_datetime": "timestamp_seconds(unix_timestamp(l_shipdate) + sec + 30 + du)",
        "passenger_count": "IF(l_quantity = 50, NULL, CAST(l_quantity AS INT) % 8)",
        "trip_distance": "CAST(dh AS DOUBLE) / 100",
        "pickup_longitude": "-CAST(CASE WHEN z < 6 THEN 73950030 + 100 * (o1 % 600)"
        " WHEN z = 6 THEN 73760030 + 100 * (o1 % 400) WHEN z = 7 THEN 73855030 + 100 * (o1 % 400)"
        " ELSE 73650030 + 100 * o1 END AS DOUBLE) / 1000000",
        "pickup_latitude": "CAST(CASE WHEN z < 6 THEN 40730030 + 100 * (a1 % 500)"
        " WHEN z = 6 THEN 40630030 + 100 * (a1 % 300) WHEN z = 7 THEN 40765030 + 100 * (a1 % 300)"
        " ELSE 40450030 + 100 * a1 END AS DOUBLE) / 1000000",
        "RateCodeID": "1",
        "store_and_fwd_flag": "'N'",
        "dropoff_longitude": "-CAST(CASE WHEN z IN (0, 1, 2, 3, 6) THEN 73950030 + 100 * (o2 % 600)"
        " WHEN z = 4 THEN 74155030 + 100 * (o2 % 400) ELSE 73650030 + 100 * o2 END AS DOUBLE) / 1000000",
        "dropoff_latitude": "CAST(CASE WHEN z IN (0, 1, 2, 3, 6) THEN 40730030 + 100 * (a2 % 500)"
        " WHEN z = 4 THEN 40675030 + 100 * (a2 % 300) ELSE 40450030 + 100 * a2 END AS DOUBLE) / 1000000",
        "payment_type": "pt",
        "fare_amount": "CAST(fc AS DOUBLE) / 100",
        "extra": "0.5D",
        "mta_tax": "0.5D",
        "tip_amount": "CAST(tc AS DOUBLE) / 100",
        "tolls_amount": "0.0D",
        "improvement_surcharge": "0.3D",
        "total_amount": "CAST(fc + coalesce(tc, 0) + 130 AS DOUBLE) / 100",
    }
    fields = ", ".join(
        f"'{f.name}', CAST({values[f.name]} AS {f.dataType.simpleString()})" for f in S.TRIP_SCHEMA.fields
    )
    # ``inline`` evaluates the formulas once per row; as plain projections they would
    # be copied into every filter on a trip column
    return cents.selectExpr(*(ROW_KEY if with_key else []), f"inline(array(named_struct({fields})))")


def trips(spark: SparkSession, sf_dir: str, with_key: bool = False) -> DataFrame:
    """Cleaned trips over the same rows."""
    return clean_trips(raw_trips(spark, sf_dir, with_key))


# The same two relations in SQL: ``raw`` and the cleaned ``trips``.
RAW_SQL = """
h0 AS (
  SELECT *, (l_orderkey*7919 + l_partkey*104729 + l_linenumber*CAST(1299709 AS BIGINT) + l_suppkey*15485863) % 1000003 AS h
  FROM lineitem),
h1 AS (
  SELECT *, h % 86400 AS s, (h*31+7) % 1100 AS x, (h*17+3) % 12000 AS du, (h*13+5) % 10 AS z,
    (h*37+11) % 5000 AS a1, (h*41+13) % 7000 AS o1, (h*43+17) % 5000 AS a2, (h*47+19) % 7000 AS o2,
    1 + l_orderkey % 4 AS pt FROM h0),
h2 AS (
  SELECT *, (s*s) // 86400 AS sec, (x*x) // 100 AS dh,
    200 + 2*((x*x) // 100) + h % 700 + CASE WHEN h % 997 = 0 THEN 50000 ELSE 0 END AS fc FROM h1),
h3 AS (
  SELECT *, CASE WHEN l_returnflag = 'A' AND l_linenumber = 1 THEN NULL
    WHEN pt = 1 THEN (fc * (h % 31)) // 100 ELSE 0 END AS tc FROM h2),
raw AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
    CAST(1 + l_suppkey % 2 AS INTEGER) AS VendorID,
    l_shipdate + to_seconds(sec) AS tpep_pickup_datetime,
    l_shipdate + to_seconds(sec + 30 + du) AS tpep_dropoff_datetime,
    CASE WHEN l_quantity = 50 THEN NULL ELSE CAST(l_quantity AS INTEGER) % 8 END AS passenger_count,
    CAST(dh AS DOUBLE)/100 AS trip_distance,
    -CAST(CASE WHEN z < 6 THEN 73950030+100*(o1%600) WHEN z = 6 THEN 73760030+100*(o1%400)
      WHEN z = 7 THEN 73855030+100*(o1%400) ELSE 73650030+100*o1 END AS DOUBLE)/1000000 AS pickup_longitude,
    CAST(CASE WHEN z < 6 THEN 40730030+100*(a1%500) WHEN z = 6 THEN 40630030+100*(a1%300)
      WHEN z = 7 THEN 40765030+100*(a1%300) ELSE 40450030+100*a1 END AS DOUBLE)/1000000 AS pickup_latitude,
    -CAST(CASE WHEN z IN (0,1,2,3,6) THEN 73950030+100*(o2%600) WHEN z = 4 THEN 74155030+100*(o2%400)
      ELSE 73650030+100*o2 END AS DOUBLE)/1000000 AS dropoff_longitude,
    CAST(CASE WHEN z IN (0,1,2,3,6) THEN 40730030+100*(a2%500) WHEN z = 4 THEN 40675030+100*(a2%300)
      ELSE 40450030+100*a2 END AS DOUBLE)/1000000 AS dropoff_latitude,
    CAST(pt AS INTEGER) AS payment_type, CAST(fc AS DOUBLE)/100 AS fare_amount,
    CAST(tc AS DOUBLE)/100 AS tip_amount, CAST(fc + coalesce(tc,0) + 130 AS DOUBLE)/100 AS total_amount,
    CAST(date_diff('second', l_shipdate + to_seconds(sec), l_shipdate + to_seconds(sec + 30 + du)) AS DOUBLE)/60.0
      AS trip_duration_minutes
  FROM h3)"""

KEEP_SQL = """trip_duration_minutes > 1 AND trip_duration_minutes < 180
    AND trip_distance > 0.1 AND trip_distance < 100 AND fare_amount > 2.5 AND fare_amount < 500
    AND passenger_count BETWEEN 1 AND 6
    AND pickup_latitude BETWEEN 40.5 AND 40.9 AND pickup_longitude BETWEEN -74.3 AND -73.7
    AND dropoff_latitude BETWEEN 40.5 AND 40.9 AND dropoff_longitude BETWEEN -74.3 AND -73.7"""

TRIPS_SQL = (
    RAW_SQL
    + f""",
trips AS (
  SELECT * REPLACE (coalesce(tip_amount, 0.0) AS tip_amount),
    round(pickup_latitude, 2) AS pickup_lat_grid, round(pickup_longitude, 2) AS pickup_lon_grid,
    round(dropoff_latitude, 2) AS dropoff_lat_grid, round(dropoff_longitude, 2) AS dropoff_lon_grid,
    CAST(hour(tpep_pickup_datetime) AS INTEGER) AS pickup_hour,
    CAST(dayofweek(tpep_pickup_datetime) + 1 AS INTEGER) AS pickup_day_of_week,
    CAST(month(tpep_pickup_datetime) AS INTEGER) AS pickup_month,
    CAST(year(tpep_pickup_datetime) AS INTEGER) AS pickup_year
  FROM raw WHERE {KEEP_SQL})"""
)
