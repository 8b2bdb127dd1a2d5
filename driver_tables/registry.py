"""Named queries over the shared tables, each with its DuckDB twin where SQL can say it.

Both sides round doubles to 4 places, because float sums differ in the last
digits, and show timestamps as text. The rounding adds a hair first: quotients of
cents often end exactly on a half, which the engines would round apart.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, TimestampNTZType, TimestampType

from curbline import schema as S
from curbline.functions import columns as C
from curbline.functions import filters
from curbline.operators import (
    anomalies,
    clean,
    clusters,
    demand,
    economic,
    explore,
    forecast,
    geo,
    models,
    moments,
    sampling,
    sketches,
    temporal,
)
from curbline.plans import batch, incremental, pages, reports, state
from curbline.plans import tables as T
from curbline.plans.store import TripStore
from curbline.session import settled, shared_dir
from curbline.sources import cells, storage
from curbline.sources import trips as source
from curbline.streaming import arrivals
from driver_tables.trips_view import KEEP_SQL, RAW_SQL, ROW_KEY, TRIPS_SQL, raw_trips, table, trips

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

HAIR = 1e-7
# small thresholds suit the small test tables
FEW = 5
SLOW_ROUTE_TRIPS = 2


def presentable(df: DataFrame) -> DataFrame:
    shown = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, DoubleType):
            c = F.round(c + HAIR, 4)
        elif isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        shown.append(c.alias(f.name))
    return df.select(*shown)


def query(name: str, sql: str | None = None, base: str | None = TRIPS_SQL):
    """Register ``fn(spark, sf_dir)``; ``sql`` may start with further CTEs after a comma."""

    def register(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: presentable(fn(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = (f"WITH {base.strip()}" if base else "") + sql
        return fn

    return register


def r4(expression: str, name: str) -> str:
    return f"round({expression} + {HAIR}, 4) AS {name}"


def ts_text(expression: str, name: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S') AS {name}"


N = "count(*) AS trip_count"
MEANS_SQL = ", ".join(
    [
        N,
        r4("avg(fare_amount)", "avg_fare"),
        r4("avg(trip_distance)", "avg_distance"),
        r4("avg(trip_duration_minutes)", "avg_duration"),
    ]
)


def case_buckets(value: str, scheme) -> str:
    edges, labels = scheme
    whens = " ".join(f"WHEN {value} < {e} THEN '{label}'" for e, label in zip(edges, labels))
    return f"CASE {whens} ELSE '{labels[-1]}' END"


HOUR_BUCKET_SQL = (
    "CASE WHEN pickup_hour BETWEEN 6 AND 11 THEN 'morning' WHEN pickup_hour BETWEEN 12 AND 17 THEN 'afternoon'"
    " WHEN pickup_hour BETWEEN 18 AND 22 THEN 'evening' ELSE 'night' END"
)

# ---- cleaning and loading ---------------------------------------------------------

_REPORT_CHECKS = {
    "duration": "trip_duration_minutes > 1 AND trip_duration_minutes < 180",
    "distance": "trip_distance > 0.1 AND trip_distance < 100",
    "fare": "fare_amount > 2.5 AND fare_amount < 500",
    "passengers": "passenger_count BETWEEN 1 AND 6",
    "pickup_location": "pickup_latitude BETWEEN 40.5 AND 40.9 AND pickup_longitude BETWEEN -74.3 AND -73.7",
    "dropoff_location": "dropoff_latitude BETWEEN 40.5 AND 40.9 AND dropoff_longitude BETWEEN -74.3 AND -73.7",
}

_DOUBLES = (
    "trip_distance pickup_longitude pickup_latitude dropoff_longitude dropoff_latitude fare_amount tip_amount total_amount"
).split()


@query(
    "clean_trips_report",
    f"""
SELECT count(*) AS input_rows, count(*) FILTER (WHERE {KEEP_SQL}) AS output_rows,
  count(*) - count(*) FILTER (WHERE {KEEP_SQL}) AS dropped_rows,
  round((count(*) - count(*) FILTER (WHERE {KEEP_SQL})) * 100.0 / count(*) + 1e-7, 4) AS dropped_percent,
  {", ".join(f"count(*) FILTER (WHERE NOT coalesce({c}, false)) AS failed_{n}" for n, c in _REPORT_CHECKS.items())},
  {" + ".join(f"count(*) FILTER (WHERE NOT isfinite({c}))" for c in _DOUBLES)} AS non_finite_cells
FROM raw""",
    base=RAW_SQL,
)
def _(spark, d):
    return clean.clean_report(raw_trips(spark, d))


@query(
    "data_quality",
    """
SELECT count(*) FILTER (WHERE tpep_pickup_datetime IS NULL) AS tpep_pickup_datetime_nulls,
  count(*) FILTER (WHERE fare_amount IS NULL) AS fare_amount_nulls,
  count(*) FILTER (WHERE trip_distance IS NULL) AS trip_distance_nulls,
  min(fare_amount) AS min_fare, max(fare_amount) AS max_fare,
  min(trip_distance) AS min_distance, max(trip_distance) AS max_distance
FROM trips""",
)
def _(spark, d):
    return clean.data_quality(trips(spark, d))


_ROWS_PER_MONTH = """
SELECT pickup_year AS year, pickup_month AS month, count(*) AS row_count,
  CAST(sum(count(*)) OVER () AS BIGINT) AS total_rows
FROM trips GROUP BY 1, 2"""


@query("rows_per_month", _ROWS_PER_MONTH)
def _(spark, d):
    return source.load_report(trips(spark, d))


@query(
    "csv_ingest_report",
    """
SELECT CAST(year(tpep_pickup_datetime) AS INTEGER) AS year, CAST(month(tpep_pickup_datetime) AS INTEGER) AS month,
  count(*) AS row_count, CAST(sum(count(*)) OVER () AS BIGINT) AS total_rows,
  round(sum(total_amount), 2) AS total_amount
FROM raw GROUP BY 1, 2""",
    base=RAW_SQL,
)
def _(spark, d):
    """All raw trips out to CSV files and back through the folder ingest."""
    drop = shared_dir(spark, "drop")
    source.export_csv(raw_trips(spark, d), drop)
    stored = source.ingest_folder(spark, drop, shared_dir(spark, "ingested"))
    money = stored.groupBy("year", "month").agg(F.round(F.sum("total_amount"), 2).alias("total_amount"))
    return source.load_report(stored).join(money, ["year", "month"])


def _odd_texts(spark, d):
    """Raw trips as text, with cells as other tools write them: passengers like ``2.0``,
    fares like ``$12.50``, pickups with the month first, and surcharges that say ``n/a``."""
    raw = raw_trips(spark, d, with_key=True)
    odd = {
        1: ("passenger_count", F.concat(F.col("passenger_count").cast("string"), F.lit(".0"))),
        2: ("fare_amount", F.concat(F.lit("$"), F.col("fare_amount").cast("string"))),
        3: ("extra", F.lit("n/a")),
        4: (C.PICKUP, F.date_format(C.PICKUP, "M/d/yyyy H:mm:ss")),
    }
    texts = {f: F.col(f).cast("string") for f in S.TRIP_SCHEMA.names}
    for line, (name, cell) in odd.items():
        texts[name] = F.when(F.col("l_linenumber") == line, cell).otherwise(texts[name])
    return raw.select(*[c.alias(f) for f, c in texts.items()])


_ODD_CELLS = {
    "passenger_count": ("passenger_count IS NULL", "l_linenumber = 1 AND passenger_count IS NOT NULL", "false"),
    "fare_amount": ("false", "l_linenumber = 2", "false"),
    "tip_amount": ("tip_amount IS NULL", "false", "false"),
    "extra": ("false", "false", "l_linenumber = 3"),
    C.PICKUP: ("false", "l_linenumber = 4", "false"),
}


def _cells_sql() -> str:
    def counted(name: str) -> str:
        tests = zip(("empty", "repaired", "rejected"), _ODD_CELLS.get(name, ("false",) * 3))
        return f"SELECT '{name}' AS column_name, count(*) AS cells, " + ", ".join(
            f"count(*) FILTER (WHERE {test}) AS {shown}" for shown, test in tests
        )

    return "\n" + "\nUNION ALL ".join(f"{counted(name)} FROM raw" for name in S.TRIP_SCHEMA.names)


@query("csv_cells", _cells_sql(), base=RAW_SQL)
def _(spark, d):
    """Cells of CSV files that a strict parse would lose: repaired, rejected and empty."""
    drop = shared_dir(spark, "drop")
    source.export_csv(_odd_texts(spark, d), drop)
    return cells.cell_report(source.read_csv_text(spark, drop))


@query("json_results", "\nSELECT pickup_hour AS hour, count(*) AS trip_count FROM trips GROUP BY 1")
def _(spark, d):
    """A result set through the JSON sink and back."""
    paths = source.write_results({"trips_by_hour": temporal.trips_by_hour(trips(spark, d))}, shared_dir(spark, "results"))
    return spark.read.schema("hour int, trip_count long").json(paths["trips_by_hour"])


# ---- temporal -----------------------------------------------------------------------

_HOURLY_SQL = f"""
SELECT pickup_year, pickup_month, pickup_day_of_week, pickup_hour, {MEANS_SQL},
  {r4("sum(fare_amount)", "total_revenue")}, {r4("avg(tip_amount)", "avg_tip")},
  {r4("avg(passenger_count)", "avg_passenger_count")},
  quantile_disc(fare_amount, 0.5) AS median_fare, quantile_disc(trip_distance, 0.5) AS median_distance
FROM trips GROUP BY 1, 2, 3, 4"""


@query("temporal_hourly_stats", _HOURLY_SQL)
def _(spark, d):
    return T.temporal_hourly_stats(trips(spark, d))


_BY_HOUR = "\nSELECT pickup_hour AS hour, count(*) AS trip_count FROM trips GROUP BY 1"


@query("trips_by_hour", _BY_HOUR)
def _(spark, d):
    return temporal.trips_by_hour(trips(spark, d))


@query("trips_by_hour_rollup", _BY_HOUR)
def _(spark, d):
    return temporal.trips_by_hour(T.temporal_hourly_stats(trips(spark, d)))


@query(
    "trips_by_hour_filtered",
    "\nSELECT pickup_hour AS hour, count(*) AS trip_count FROM trips"
    " WHERE pickup_year = 1997 AND pickup_month = 6 AND pickup_day_of_week = 2 GROUP BY 1",
)
def _(spark, d):
    return temporal.trips_by_hour(trips(spark, d), year=1997, month=6, day_of_week=2)


@query("trips_by_day", "\nSELECT pickup_day_of_week AS day_of_week, count(*) AS trip_count FROM trips GROUP BY 1")
def _(spark, d):
    return temporal.trips_by_day(trips(spark, d))


@query(
    "trips_by_month",
    "\nSELECT pickup_year AS year, pickup_month AS month, count(*) AS trip_count FROM trips GROUP BY 1, 2",
)
def _(spark, d):
    return temporal.trips_by_month(trips(spark, d))


@query("peak_hours", _BY_HOUR + " ORDER BY trip_count DESC, hour LIMIT 10")
def _(spark, d):
    return temporal.peak_hours(trips(spark, d))


@query(
    "busiest_quietest",
    """, h AS (SELECT pickup_hour AS k, count(*) AS n FROM trips GROUP BY 1),
w AS (SELECT pickup_day_of_week AS k, count(*) AS n FROM trips GROUP BY 1)
SELECT a.k AS busiest_hour, a.n AS busiest_hour_trips, b.k AS quietest_hour, b.n AS quietest_hour_trips,
  c.k AS peak_day, c.n AS peak_day_trips, e.k AS lowest_day, e.n AS lowest_day_trips
FROM (SELECT * FROM h ORDER BY n DESC, k LIMIT 1) a, (SELECT * FROM h ORDER BY n, k LIMIT 1) b,
  (SELECT * FROM w ORDER BY n DESC, k LIMIT 1) c, (SELECT * FROM w ORDER BY n, k LIMIT 1) e""",
)
def _(spark, d):
    return temporal.busiest_quietest(trips(spark, d))


_DURATION_SQL = f"""
SELECT {r4("avg(trip_duration_minutes)", "mean")}, {r4("stddev_samp(trip_duration_minutes)", "stddev")},
  {r4("min(trip_duration_minutes)", "min")}, {r4("max(trip_duration_minutes)", "max")},
  {", ".join(r4(f"quantile_disc(trip_duration_minutes, {p})", n) for n, p in temporal.DURATION_QUANTILES.items())}
FROM trips"""


@query("duration_distribution", _DURATION_SQL)
def _(spark, d):
    return temporal.duration_distribution(trips(spark, d))


_TRENDS = r4("avg(fare_amount)", "avg_fare") + ", " + r4("avg(trip_distance)", "avg_distance")


@query("fare_trends_hour", f"\nSELECT pickup_hour AS hour, {_TRENDS} FROM trips GROUP BY 1")
def _(spark, d):
    return temporal.fare_trends(trips(spark, d), "hour")


@query("fare_trends_day", f"\nSELECT pickup_day_of_week AS day_of_week, {_TRENDS} FROM trips GROUP BY 1")
def _(spark, d):
    return temporal.fare_trends(trips(spark, d), "day")


@query("fare_trends_month", f"\nSELECT pickup_year AS year, pickup_month AS month, {_TRENDS} FROM trips GROUP BY 1, 2")
def _(spark, d):
    return temporal.fare_trends(trips(spark, d), "month")


@query("fare_trends_month_rollup", f"\nSELECT pickup_year AS year, pickup_month AS month, {_TRENDS} FROM trips GROUP BY 1, 2")
def _(spark, d):
    return temporal.fare_trends(T.temporal_hourly_stats(trips(spark, d)), "month")


@query(
    "hourly_slots",
    f", t AS ({_HOURLY_SQL}) SELECT * FROM t WHERE pickup_year = 1997 AND pickup_day_of_week IN (1, 7) AND pickup_hour = 0",
)
def _(spark, d):
    return temporal.hourly_slots(T.temporal_hourly_stats(trips(spark, d)), year=1997, day_of_week=[1, 7], hour=0)


def _daily_sql(relation: str, ts: str) -> str:
    return f"""daily AS (
  SELECT strftime({ts}, '%Y-%m-%d') AS date, count(*) AS trip_count FROM {relation} GROUP BY 1)"""


_TREND_SQL = """
SELECT date, trip_count,
  round(avg(trip_count) OVER (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) + 1e-7, 4) AS trend
FROM daily"""
_SEASONAL_SQL = """
SELECT CAST(dayofweek(CAST(date AS DATE)) + 1 AS INTEGER) AS day_of_week, round(avg(trip_count) + 1e-7, 4) AS avg_trips,
  count(*) AS day_count
FROM daily GROUP BY 1"""


@query("daily_trend_7", ", " + _daily_sql("trips", "tpep_pickup_datetime") + _TREND_SQL)
def _(spark, d):
    return temporal.daily_trend(trips(spark, d))


_RANGE = ("1996-01-15 12:00:00", "1996-04-01 00:00:00")


@query(
    "daily_trend_range",
    ", scoped AS (SELECT * FROM trips WHERE tpep_pickup_datetime BETWEEN '%s' AND '%s'), " % _RANGE
    + _daily_sql("scoped", "tpep_pickup_datetime")
    + _TREND_SQL,
)
def _(spark, d):
    return temporal.daily_trend(filters.time_range(trips(spark, d), *_RANGE))


@query("seasonal_by_dow", ", " + _daily_sql("trips", "tpep_pickup_datetime") + _SEASONAL_SQL)
def _(spark, d):
    return temporal.seasonal_by_day(trips(spark, d))


@query(
    "decomposition",
    ", "
    + _daily_sql("trips", "tpep_pickup_datetime")
    + """, parts AS (
  SELECT date, trip_count, CAST(dayofweek(CAST(date AS DATE)) + 1 AS INTEGER) AS day_of_week,
    avg(trip_count) OVER (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS trend,
    avg(trip_count) OVER (PARTITION BY dayofweek(CAST(date AS DATE))) - avg(trip_count) OVER () AS seasonal
  FROM daily)
SELECT date, trip_count, round(trend + 1e-7, 4) AS trend, day_of_week, round(seasonal + 1e-7, 4) AS seasonal,
  round(trip_count - trend - seasonal + 1e-7, 4) AS residual FROM parts""",
)
def _(spark, d):
    return temporal.decomposition(trips(spark, d))


@query("events_daily_trend", "WITH " + _daily_sql("events", "ts") + _TREND_SQL, base=None)
def _(spark, d):
    return temporal.daily_trend(table(spark, d, "events"), ts="ts")


@query("events_seasonal_by_dow", "WITH " + _daily_sql("events", "ts") + _SEASONAL_SQL, base=None)
def _(spark, d):
    return temporal.seasonal_by_day(table(spark, d, "events"), ts="ts")


# ---- geospatial -----------------------------------------------------------------------

_ROUTE = "pickup_lat_grid, pickup_lon_grid, dropoff_lat_grid, dropoff_lon_grid"
_ZONES_SQL = f"""
SELECT {_ROUTE}, pickup_year, pickup_month, {HOUR_BUCKET_SQL} AS hour_bucket, {MEANS_SQL}
FROM trips GROUP BY 1, 2, 3, 4, 5, 6, 7"""


@query("zone_stats", _ZONES_SQL)
def _(spark, d):
    return T.geospatial_zone_stats(trips(spark, d))


@query(
    "zone_query",
    f", z AS ({_ZONES_SQL}) SELECT * FROM z WHERE pickup_year = 1997 AND pickup_month = 6"
    " AND hour_bucket = 'night' AND trip_count >= 2",
)
def _(spark, d):
    return geo.zone_query(T.geospatial_zone_stats(trips(spark, d)), 1997, 6, "night", min_trips=2)


def _hotspot_sql(side: str) -> str:
    return f"""
SELECT {side}_lat_grid AS latitude, {side}_lon_grid AS longitude, count(*) AS trip_count
FROM trips GROUP BY 1, 2 HAVING count(*) >= {FEW} ORDER BY 3 DESC, 1, 2 LIMIT 20"""


@query("pickup_hotspots", _hotspot_sql("pickup"))
def _(spark, d):
    return geo.pickup_hotspots(trips(spark, d), min_trips=FEW)


@query("dropoff_hotspots", _hotspot_sql("dropoff"))
def _(spark, d):
    return geo.dropoff_hotspots(trips(spark, d), min_trips=FEW)


@query("pickup_hotspots_rollup", _hotspot_sql("pickup"))
def _(spark, d):
    return geo.pickup_hotspots(T.geospatial_zone_stats(trips(spark, d)), min_trips=FEW)


def _point(side: str) -> str:
    return f"printf('%.2f', {side}_lat_grid) || ',' || printf('%.2f', {side}_lon_grid) AS {side}"


@query(
    "route_pairs",
    f""", t AS (SELECT {_ROUTE}, {N}, {_TRENDS} FROM trips GROUP BY 1, 2, 3, 4
  ORDER BY trip_count DESC, 1, 2, 3, 4 LIMIT 20)
SELECT {_point("pickup")}, {_point("dropoff")}, trip_count, avg_fare, avg_distance FROM t""",
)
def _(spark, d):
    return geo.route_pairs(trips(spark, d))


@query(
    "route_pairs_by_month",
    f""", t AS (SELECT {_ROUTE}, pickup_year, pickup_month, {N}, {_TRENDS} FROM trips GROUP BY 1, 2, 3, 4, 5, 6
  ORDER BY trip_count DESC, 1, 2, 3, 4, 5, 6 LIMIT 20)
SELECT {_point("pickup")}, {_point("dropoff")}, pickup_year, pickup_month, trip_count, avg_fare, avg_distance FROM t""",
)
def _(spark, d):
    return geo.route_pairs(trips(spark, d), by_month=True)


def _routes_sql(min_trips: int) -> str:
    return f"""
SELECT {_ROUTE}, pickup_year, pickup_month, {MEANS_SQL},
  count(*) FILTER (WHERE pickup_day_of_week IN (1, 7)) AS trip_count_weekend,
  count(*) FILTER (WHERE pickup_day_of_week NOT IN (1, 7)) AS trip_count_weekday
FROM trips GROUP BY 1, 2, 3, 4, 5, 6 HAVING count(*) >= {min_trips}"""


@query("route_pairs_top", _routes_sql(SLOW_ROUTE_TRIPS))
def _(spark, d):
    return T.route_pairs_top(trips(spark, d), min_trips=SLOW_ROUTE_TRIPS)


def _density_sql(size: float) -> str:
    return f""", c AS (
  SELECT CAST(round(pickup_latitude / {size}) AS BIGINT) AS a, CAST(round(pickup_longitude / {size}) AS BIGINT) AS o,
    count(*) AS density FROM trips GROUP BY 1, 2 HAVING count(*) > 10 ORDER BY 3 DESC, 1, 2 LIMIT 100)
SELECT round(a * CAST({size} AS DOUBLE) + 1e-7, 4) AS latitude, round(o * CAST({size} AS DOUBLE) + 1e-7, 4) AS longitude, density FROM c"""


@query("spatial_density", _density_sql(0.01))
def _(spark, d):
    return geo.spatial_density(trips(spark, d))


@query("spatial_density_coarse", _density_sql(0.05))
def _(spark, d):
    return geo.spatial_density(trips(spark, d), grid_size=0.05)


def _box_sql(side: str, name: str, half: float | None) -> str:
    a = next(x for x in S.AIRPORTS if x["name"] == name)
    half = a["radius_miles"] * S.DEGREES_PER_RADIUS_MILE if half is None else half
    return (
        f"({side}_latitude BETWEEN {a['lat'] - half!r} AND {a['lat'] + half!r}"
        f" AND {side}_longitude BETWEEN {a['lon'] - half!r} AND {a['lon'] + half!r})"
    )


def _label_sql(side: str) -> str:
    whens = " ".join(f"WHEN {_box_sql(side, a['name'], None)} THEN '{a['name']}'" for a in S.AIRPORTS)
    return f"CASE {whens} END"


_AIRPORT_CTE = f""", flagged AS (
  SELECT *, {_label_sql("pickup")} AS pickup_airport, {_label_sql("dropoff")} AS dropoff_airport FROM trips)"""


@query(
    "airport_analysis",
    _AIRPORT_CTE
    + f"""
SELECT coalesce(pickup_airport, dropoff_airport) AS airport_name,
  CASE WHEN pickup_airport IS NOT NULL THEN 'from_airport' ELSE 'to_airport' END AS direction,
  pickup_year, pickup_month, pickup_day_of_week, pickup_hour, {MEANS_SQL}
FROM flagged WHERE pickup_airport IS NOT NULL OR dropoff_airport IS NOT NULL GROUP BY 1, 2, 3, 4, 5, 6""",
)
def _(spark, d):
    return T.airport_analysis(trips(spark, d))


def _compare_sql(city: bool) -> str:
    parts = [
        f"SELECT '{a}' AS zone, {MEANS_SQL} FROM trips WHERE {_box_sql('pickup', a, S.COMPARED_HALF_WIDTH)}"
        for a in S.COMPARED_AIRPORTS
    ]
    if city:
        parts.append(f"SELECT 'city' AS zone, {MEANS_SQL} FROM trips")
    return "\n" + " UNION ALL ".join(parts)


@query("airport_compare", _compare_sql(False))
def _(spark, d):
    return geo.airport_compare(trips(spark, d))


@query("zone_comparison", _compare_sql(True))
def _(spark, d):
    return geo.zone_comparison(trips(spark, d))


@query(
    "haversine_miles",
    f""", m AS (SELECT *, 2 * 3959 * asin(sqrt(least(1.0,
    pow(sin((radians(dropoff_latitude) - radians(pickup_latitude)) / 2), 2)
    + cos(radians(pickup_latitude)) * cos(radians(dropoff_latitude))
    * pow(sin((radians(dropoff_longitude) - radians(pickup_longitude)) / 2), 2)))) AS miles FROM trips)
SELECT {_ROUTE}, {N}, round(avg(miles) + 1e-7, 4) AS avg_miles, round(max(miles) + 1e-7, 4) AS max_miles FROM m GROUP BY 1, 2, 3, 4""",
)
def _(spark, d):
    miles = C.haversine_miles("pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude")
    return trips(spark, d).groupBy(*geo.ROUTE_KEYS).agg(
        F.count(F.lit(1)).alias("trip_count"), F.avg(miles).alias("avg_miles"), F.max(miles).alias("max_miles")
    )


# ---- economic -------------------------------------------------------------------------

_FARES_SQL = f"""
SELECT {case_buckets("trip_distance", S.DISTANCE_5WAY)} AS distance_bucket,
  {case_buckets("trip_duration_minutes", S.DURATION_4WAY)} AS duration_bucket,
  pickup_hour, pickup_day_of_week, payment_type, {N},
  {r4("avg(fare_amount)", "avg_fare")}, {r4("avg(tip_amount)", "avg_tip")},
  {r4("avg(tip_amount) / avg(fare_amount) * 100", "tip_percentage")}, {r4("sum(fare_amount)", "total_revenue")},
  {r4("avg(fare_amount) / avg(trip_distance)", "fare_per_mile")},
  {r4("avg(fare_amount) / avg(trip_duration_minutes)", "fare_per_minute")}
FROM trips GROUP BY 1, 2, 3, 4, 5"""


def _tips_sql(keys: str, scheme, median: bool) -> str:
    return f"""
SELECT {keys.format(bucket=case_buckets("trip_distance", scheme) + " AS distance_bucket")}, {N},
  {r4("avg(tip_amount)", "avg_tip")}, {"quantile_disc(tip_amount, 0.5) AS median_tip," if median else ""}
  {r4("avg(tip_amount) / avg(fare_amount) * 100", "tip_percentage")},
  {r4("count(*) FILTER (WHERE tip_amount / fare_amount > 0.25) * 100.0 / count(*)", "high_tipper_rate")},
  {r4("count(*) FILTER (WHERE tip_amount = 0) * 100.0 / count(*)", "no_tip_rate")}
FROM trips GROUP BY ALL"""


_TIPS_SQL = _tips_sql("payment_type, pickup_hour, {bucket}, passenger_count", S.DISTANCE_3WAY, True)


@query("fare_analysis", _FARES_SQL)
def _(spark, d):
    return T.economic_fare_analysis(trips(spark, d))


@query("tip_behavior", _TIPS_SQL)
def _(spark, d):
    return T.tip_behavior_analysis(trips(spark, d))


def _tip_sql(keys: str, group: str) -> str:
    return f"""
SELECT {keys}, round(avg(CASE WHEN fare_amount > 0 THEN tip_amount / fare_amount * 100 ELSE 0 END) + 1e-7, 4)
  AS avg_tip_percent, {N} FROM trips GROUP BY {group}"""


_LOCATION = "pickup_lat_grid AS latitude, pickup_lon_grid AS longitude"
_TITLES = case_buckets("trip_distance", S.DISTANCE_3WAY_TITLES) + " AS distance_bucket"


@query("tip_by_payment", _tip_sql("payment_type", "1"))
def _(spark, d):
    return economic.tip_analysis(trips(spark, d), "payment_type")


@query("tip_by_hour", _tip_sql("pickup_hour AS hour", "1"))
def _(spark, d):
    return economic.tip_analysis(trips(spark, d), "hour")


@query("tip_by_distance", _tip_sql(_TITLES, "1"))
def _(spark, d):
    return economic.tip_analysis(trips(spark, d), "distance_bucket", guarded=False)


@query("tip_by_distance_rollup", _tip_sql(_TITLES, "1"))
def _(spark, d):
    return state.tip_analysis(state.fare_state(trips(spark, d)), "distance_bucket")


@query("tip_by_location", _tip_sql(_LOCATION, "1, 2"))
def _(spark, d):
    return economic.tip_analysis(trips(spark, d), "location")


@query(
    "tip_ratio_by_payment",
    f"\nSELECT payment_type, {r4('sum(tip_amount) / sum(fare_amount) * 100', 'tip_ratio_percent')}, {N} FROM trips GROUP BY 1",
)
def _(spark, d):
    return economic.tip_ratio(trips(spark, d), "payment_type")


@query(
    "tip_group_mean_by_hour",
    """, t AS (SELECT pickup_hour, avg(tip_amount) / avg(fare_amount) * 100 AS p FROM trips
  GROUP BY pickup_hour, payment_type, """
    + case_buckets("trip_distance", S.DISTANCE_3WAY)
    + """, passenger_count)
SELECT pickup_hour AS hour, round(avg(p) + 1e-7, 4) AS avg_tip_percent FROM t GROUP BY 1""",
)
def _(spark, d):
    return economic.tip_group_mean(T.tip_behavior_analysis(trips(spark, d)), "hour")


def _revenue_sql(keys: str, group: str) -> str:
    return f"\nSELECT {keys}, {r4('avg(total_amount)', 'avg_revenue')}, {N} FROM trips GROUP BY {group}"


@query("revenue_by_hour", _revenue_sql("pickup_hour AS hour", "1"))
def _(spark, d):
    return economic.revenue_analysis(trips(spark, d), "hour")


@query("revenue_by_hour_rollup", _revenue_sql("pickup_hour AS hour", "1"))
def _(spark, d):
    return state.revenue_by_hour(state.fare_state(trips(spark, d)))


@query("revenue_by_location", _revenue_sql(_LOCATION, "1, 2"))
def _(spark, d):
    return economic.revenue_analysis(trips(spark, d), "location")


_ELASTICITY_SQL = f"""
SELECT {case_buckets("trip_distance", S.DISTANCE_4WAY)} AS distance_bucket,
  {r4("avg(fare_amount / trip_distance)", "avg_fare_per_mile")}, {_TRENDS}, {N}
FROM trips WHERE trip_distance > 0 GROUP BY 1"""


@query("price_elasticity", _ELASTICITY_SQL)
def _(spark, d):
    return economic.price_elasticity(trips(spark, d))


@query("price_elasticity_rollup", _ELASTICITY_SQL)
def _(spark, d):
    return state.price_elasticity(state.fare_state(trips(spark, d)))


@query(
    "market_share",
    f"""
SELECT VendorID AS vendor_id, {N}, {r4("count(*) * 100.0 / sum(count(*)) OVER ()", "market_share_percent")},
  {r4("avg(fare_amount)", "avg_fare")}, {r4("avg(total_amount)", "avg_total")} FROM trips GROUP BY 1""",
)
def _(spark, d):
    return economic.market_share(trips(spark, d))


@query(
    "economic_insights",
    _AIRPORT_CTE
    + """, hr AS (SELECT pickup_hour AS k, sum(tip_amount) / sum(fare_amount) * 100 AS tip, avg(fare_amount) AS fare
  FROM trips GROUP BY 1),
a AS (SELECT avg(fare_amount) AS fare FROM flagged WHERE pickup_airport IS NOT NULL OR dropoff_airport IS NOT NULL),
c AS (SELECT avg(fare_amount) AS fare,
    sum(tip_amount) FILTER (WHERE payment_type = 1) / sum(fare_amount) FILTER (WHERE payment_type = 1) * 100 AS card,
    sum(tip_amount) FILTER (WHERE payment_type = 2) / sum(fare_amount) FILTER (WHERE payment_type = 2) * 100 AS cash
  FROM trips)
SELECT (SELECT k FROM hr ORDER BY tip DESC, k LIMIT 1) AS highest_tip_hour,
  (SELECT round(max(tip) + 1e-7, 4) FROM hr) AS highest_tip_percent,
  (SELECT k FROM hr ORDER BY fare DESC, k LIMIT 1) AS best_revenue_hour,
  round((a.fare - c.fare) / c.fare * 100 + 1e-7, 4) AS airport_premium,
  round(CASE WHEN cash > 0 THEN card - cash ELSE 0.0 END + 1e-7, 4) AS credit_card_tip_premium,
  round(card + 1e-7, 4) AS credit_tip_rate, round(cash + 1e-7, 4) AS cash_tip_rate FROM a, c""",
)
def _(spark, d):
    return economic.economic_insights(trips(spark, d))


def _correlation_sql() -> str:
    cells = []
    for a in economic.CORRELATED:
        for b in economic.CORRELATED:
            value = "1.0" if a == b else f"round(corr({a}, {b}) + 1e-7, 4)"
            cells.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, CAST({value} AS DOUBLE) AS corr FROM trips" + (" LIMIT 1" if a == b else ""))
    return "\n" + " UNION ALL ".join(f"({c})" for c in cells)


@query("correlations", _correlation_sql())
def _(spark, d):
    return economic.correlations(trips(spark, d))


_SURGE_CTE = """, sc AS (
  SELECT pickup_hour AS hour, fare_amount, tpep_pickup_datetime,
    avg(fare_amount) OVER w AS m, stddev_samp(fare_amount) OVER w AS s
  FROM trips WINDOW w AS (PARTITION BY pickup_hour, pickup_lat_grid, pickup_lon_grid)),
z AS (SELECT *, CASE WHEN s IS NULL OR s = 0 THEN 0.0 ELSE (fare_amount - m) / s END AS z FROM sc)"""


@query(
    "fare_surge_hours",
    _SURGE_CTE
    + """
SELECT hour, count(*) AS surge_count, round(avg(fare_amount) + 1e-7, 4) AS avg_surge_fare, round(avg(z) + 1e-7, 4) AS avg_z_score
FROM z WHERE abs(z) > 3.0 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
)
def _(spark, d):
    return economic.fare_surge_hours(trips(spark, d))


@query(
    "fare_surge_totals",
    _SURGE_CTE
    + """, t AS (SELECT count(*) FILTER (WHERE abs(z) > 3.0) AS e, count(*) AS n,
  date_diff('month', min(tpep_pickup_datetime), max(tpep_pickup_datetime)) + 1 AS months FROM z)
SELECT e AS total_surge_events, round(e * 100.0 / n + 1e-7, 4) AS surge_percentage,
  round(CAST(e AS DOUBLE) / months + 1e-7, 4) AS events_per_month, CAST(3.0 AS DOUBLE) AS threshold FROM t""",
)
def _(spark, d):
    return economic.fare_surge_totals(trips(spark, d))


# ---- exploration ----------------------------------------------------------------------


def _summary_sql() -> str:
    spread = {"fare": "fare_amount", "distance": "trip_distance", "duration": "trip_duration_minutes"}
    plain = {"tip": "tip_amount", "passengers": "passenger_count"}
    cols = []
    for n, c in {**spread, **plain}.items():
        rounded = c != "passenger_count"
        cols += [
            r4(f"avg({c})", f"avg_{n}"),
            r4(f"min({c})", f"min_{n}") if rounded else f"min({c}) AS min_{n}",
            r4(f"max({c})", f"max_{n}") if rounded else f"max({c}) AS max_{n}",
        ]
    cols += [r4(f"stddev_samp({c})", f"stddev_{n}") for n, c in spread.items()]
    return f"""
SELECT count(*) AS total_records, {ts_text("min(tpep_pickup_datetime)", "min_date")},
  {ts_text("max(tpep_pickup_datetime)", "max_date")}, {r4("sum(fare_amount)", "total_revenue")}, {", ".join(cols)},
  {r4("avg(fare_amount) / avg(trip_distance)", "avg_fare_per_mile")},
  {r4("avg(tip_amount) / avg(fare_amount) * 100", "avg_tip_rate")} FROM trips"""


@query("summary_stats", _summary_sql())
def _(spark, d):
    return T.summary_stats(trips(spark, d))


@query("summary_stats_merged", _summary_sql())
def _(spark, d):
    """The summary merged from per-month state."""
    return state.summary_from_state(state.summary_state(trips(spark, d)))


@query("tip_behavior_merged", _TIPS_SQL)
def _(spark, d):
    """The tip table, median included, rolled up from per-month state."""
    t = trips(spark, d)
    return state.tips_from_state(state.tip_state(t), state.tip_values(t))


_DESCRIBED = ["passenger_count", "trip_distance", "fare_amount", "tip_amount", "total_amount", "trip_duration_minutes"]


@query(
    "describe_columns",
    "\n"
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS count, {r4(f'avg({c})', 'mean')},"
        f" {r4(f'stddev_samp({c})', 'stddev')}, {r4(f'CAST(min({c}) AS DOUBLE)', 'min')},"
        f" {r4(f'CAST(max({c}) AS DOUBLE)', 'max')} FROM trips"
        for c in _DESCRIBED
    ),
)
def _(spark, d):
    return explore.describe_columns(trips(spark, d), _DESCRIBED)


@query(
    "date_range",
    f"""
SELECT {ts_text("min(tpep_pickup_datetime)", "min_date")}, {ts_text("max(tpep_pickup_datetime)", "max_date")},
  CAST(min(pickup_year) AS INTEGER) AS min_year, CAST(max(pickup_year) AS INTEGER) AS max_year FROM trips""",
)
def _(spark, d):
    return explore.date_range(trips(spark, d))


def _histogram_sql(relation: str, field: str, bins: int, where: str = "true") -> str:
    return f"""b AS (SELECT min({field}) AS lo, max({field}) AS hi FROM {relation} WHERE {where}),
w AS (SELECT lo, CASE WHEN hi > lo THEN (hi - lo) / {bins} ELSE 1.0 END AS wd FROM b),
k AS (SELECT CAST(least(floor(({field} - lo) / wd), {bins - 1}) AS INTEGER) AS bin, lo, wd FROM {relation}, w
  WHERE {field} IS NOT NULL AND {where})
SELECT bin, {r4("lo + bin * wd", "bin_start")}, {r4("lo + (bin + 1) * wd", "bin_end")}, count(*) AS count
FROM k GROUP BY bin, lo, wd"""


@query("histogram_fare", ", " + _histogram_sql("trips", "fare_amount", 20))
def _(spark, d):
    return explore.histogram(trips(spark, d), "fare_amount", digits=None).drop("label")


@query("histogram_distance_1997", ", " + _histogram_sql("trips", "trip_distance", 10, "pickup_year = 1997"))
def _(spark, d):
    return explore.histogram(trips(spark, d), "trip_distance", bins=10, year=1997, digits=None).drop("label")


@query(
    "histogram_labels",
    """, b AS (SELECT min(fare_amount) AS lo, max(fare_amount) AS hi FROM trips),
k AS (SELECT CAST(least(floor((fare_amount - lo) / ((hi - lo) / 8)), 7) AS INTEGER) AS bin, lo, (hi - lo) / 8 AS wd FROM trips, b)
SELECT bin, count(*) AS count, printf('%.1f-%.1f', round(lo + bin * wd, 1), round(lo + (bin + 1) * wd, 1)) AS label
FROM k GROUP BY bin, lo, wd""",
)
def _(spark, d):
    return explore.histogram(trips(spark, d), "fare_amount", 8).select("bin", "count", "label")


@query("events_histogram", "WITH " + _histogram_sql("events", "value", 20), base=None)
def _(spark, d):
    return explore.histogram(table(spark, d, "events"), "value", digits=None).drop("label")


_PAGE_SQL = ", ".join(
    ts_text(c, c)
    if c.endswith("datetime")
    else (r4(c, c) if c in ("trip_distance", "fare_amount", "tip_amount", "total_amount", "trip_duration_minutes") else c)
    for c in explore.PAGE_COLUMNS
)


def _page_order(first: str, direction: str) -> str:
    nulls = "NULLS FIRST" if direction == "asc" else "NULLS LAST"
    names = [first] + [c for c in explore.PAGE_COLUMNS if c != first]
    return ", ".join(f"{c} {direction} {nulls}" for c in names)


def _page_sql(first: str, direction: str, limit: int, offset: int = 0, where: str = "true") -> str:
    return f""", p AS (SELECT * FROM trips WHERE {where} ORDER BY {_page_order(first, direction)}
  LIMIT {limit} OFFSET {offset}) SELECT {_PAGE_SQL} FROM p"""


@query("head_rows", _page_sql(C.PICKUP, "asc", 100))
def _(spark, d):
    return explore.head_rows(trips(spark, d))


@query("explore_page_1", _page_sql(C.PICKUP, "asc", 100))
def _(spark, d):
    return explore.explore(trips(spark, d))


@query(
    "explore_page_3",
    _page_sql("fare_amount", "desc", 50, 100, "payment_type = 1 AND fare_amount >= 5 AND fare_amount <= 25 AND passenger_count >= 2"),
)
def _(spark, d):
    return explore.explore(
        trips(spark, d), 3, 50, "fare_amount", "desc", payment_type=1, min_fare=5, max_fare=25, min_passengers=2
    )


@query("explore_deep_page", _page_sql("trip_distance", "asc", 100, 15_000))
def _(spark, d):
    """A page far from the front, reached by skipping groups."""
    return explore.explore(trips(spark, d), 151, 100, "trip_distance", rest_rows=500)


@query("explore_by_longitude", _page_sql("pickup_longitude", "desc", 80, 14_960))
def _(spark, d):
    """A deep page in the order of a column whose values are nearly all different."""
    return explore.explore(trips(spark, d), 188, 80, "pickup_longitude", "desc", rest_rows=200)


@query(
    "explore_ranges",
    _page_sql("total_amount", "asc", 60, 120, "trip_distance >= 2 AND trip_distance <= 30 AND passenger_count <= 4"),
)
def _(spark, d):
    return explore.explore(trips(spark, d), 3, 60, "total_amount", min_distance=2, max_distance=30, max_passengers=4)


@query("explore_after", _page_sql("fare_amount", "asc", 70, 140))
def _(spark, d):
    """The third page, found from the last row of the second."""
    t = trips(spark, d)
    last = explore.explore(t, 2, 70, "fare_amount").collect()[-1].asDict()
    return explore.explore_after(t, last, 70, "fare_amount")


@query(
    "page_info",
    """
SELECT CAST(3 AS INTEGER) AS page, CAST(50 AS INTEGER) AS page_size, count(*) AS total_count,
  CAST(ceil(count(*) / 50.0) AS BIGINT) AS total_pages, 3 < ceil(count(*) / 50.0) AS has_next, true AS has_previous
FROM trips WHERE payment_type = 1 AND fare_amount >= 5 AND fare_amount <= 25""",
)
def _(spark, d):
    return explore.page_info(trips(spark, d), 3, 50, payment_type=1, min_fare=5, max_fare=25)


@query(
    "scatter_sample",
    """, p AS (SELECT trip_distance, fare_amount FROM trips
  ORDER BY md5(concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber)), trip_distance, fare_amount LIMIT 1000)
SELECT round(trip_distance + 1e-7, 4) AS trip_distance, round(fare_amount + 1e-7, 4) AS fare_amount FROM p""",
)
def _(spark, d):
    return explore.scatter(trips(spark, d, with_key=True), "trip_distance", "fare_amount", ROW_KEY)


# ---- demand, revenue, anomalies ---------------------------------------------------------

_SLOT_COUNTS = """, h AS (
  SELECT pickup_year, pickup_month, pickup_day_of_week, pickup_hour, count(*) AS trip_count
  FROM trips GROUP BY 1, 2, 3, 4)"""
_SURGES = (
    _SLOT_COUNTS
    + """, hs AS (
  SELECT *, avg(trip_count) OVER w AS mean, stddev_samp(trip_count) OVER w AS std
  FROM h WINDOW w AS (PARTITION BY pickup_year, pickup_month, pickup_day_of_week)),
surge AS (SELECT *, (trip_count - mean) / CASE WHEN std = 0 THEN 1.0 ELSE std END AS z_score FROM hs
  WHERE (trip_count - mean) / CASE WHEN std = 0 THEN 1.0 ELSE std END > 1.5)"""
)


_KEPT_ROWS = "substr(md5(concat_ws('|', '42', l_orderkey, l_partkey, l_suppkey, l_linenumber)), 1, 8) < '40000000'"


def _sampled_sql(relation: str) -> str:
    return f"""
SELECT VendorID AS vendor_id, {N}, {r4("sum(fare_amount)", "fares")} FROM {relation} WHERE {_KEPT_ROWS} GROUP BY 1"""


@query("bernoulli_trips", _sampled_sql("trips"))
def _(spark, d):
    """A quarter of the trips by their keys, over two partitionings that agree."""
    t = trips(spark, d, with_key=True)
    kept = sampling.bernoulli(t, 0.25, key_columns=ROW_KEY)
    dealt = sampling.bernoulli(t.repartition(5, "l_linenumber"), 0.25, key_columns=ROW_KEY).select(*ROW_KEY)
    both = kept.join(dealt, ROW_KEY, "left_semi")
    return both.groupBy(F.col("VendorID").alias("vendor_id")).agg(
        F.count(F.lit(1)).alias("trip_count"), F.sum("fare_amount").alias("fares")
    )


@query(
    "demand_surge",
    _SURGES
    + """
SELECT pickup_year, pickup_month, pickup_day_of_week, pickup_hour, trip_count, round(mean + 1e-7, 4) AS mean,
  round(std + 1e-7, 4) AS std, round(z_score + 1e-7, 4) AS z_score FROM surge""",
)
def _(spark, d):
    return demand.demand_surge(T.temporal_hourly_stats(trips(spark, d)))


@query(
    "hot_zones",
    _SURGES
    + f""", zn AS ({_ZONES_SQL})
SELECT zn.*, s.pickup_day_of_week, s.pickup_hour FROM zn
JOIN (SELECT pickup_year, pickup_month, pickup_day_of_week, pickup_hour FROM surge) s
  ON zn.pickup_year = s.pickup_year AND zn.pickup_month = s.pickup_month
ORDER BY trip_count DESC, {", ".join("zn." + c for c in T.ZONE_KEYS)}, s.pickup_day_of_week, s.pickup_hour LIMIT 100""",
)
def _(spark, d):
    t = trips(spark, d)
    return demand.hot_zones(T.geospatial_zone_stats(t), settled(demand.demand_surge(T.temporal_hourly_stats(t))))


@query(
    "revenue_windows",
    f"""
SELECT pickup_day_of_week, pickup_hour, {r4("sum(fare_amount)", "total_revenue")} FROM trips GROUP BY 1, 2
ORDER BY sum(fare_amount) DESC, 1, 2 LIMIT 48""",
)
def _(spark, d):
    return demand.revenue_windows(T.economic_fare_analysis(trips(spark, d)))


@query(
    "inefficient_routes",
    f""", t AS (SELECT {_ROUTE}, pickup_year, pickup_month, {MEANS_SQL},
    count(*) FILTER (WHERE pickup_day_of_week IN (1, 7)) AS trip_count_weekend,
    count(*) FILTER (WHERE pickup_day_of_week NOT IN (1, 7)) AS trip_count_weekday,
    avg(trip_duration_minutes) / greatest(avg(trip_distance), 0.1) AS mpm
  FROM trips GROUP BY 1, 2, 3, 4, 5, 6 HAVING count(*) > {SLOW_ROUTE_TRIPS})
SELECT * EXCLUDE (mpm), round(mpm + 1e-7, 4) AS minutes_per_mile FROM t ORDER BY mpm DESC, 1, 2, 3, 4, 5, 6 LIMIT 50""",
)
def _(spark, d):
    return demand.inefficient_routes(T.route_pairs_top(trips(spark, d), min_trips=1), above=SLOW_ROUTE_TRIPS)


@query(
    "ordinal_slots",
    _SLOT_COUNTS
    + """
SELECT CAST(row_number() OVER (ORDER BY pickup_year, pickup_month, pickup_day_of_week, pickup_hour) - 1 AS INTEGER)
  AS time_index, * FROM h""",
)
def _(spark, d):
    return demand.ordinal_slots(T.temporal_hourly_stats(trips(spark, d)))


def _robust_sql(relation: str, features: list[str], show: str) -> str:
    medians = ", ".join(f"quantile_disc(CAST({f} AS DOUBLE), 0.5) AS m_{f}" for f in features)
    spreads = ", ".join(
        f"quantile_disc(abs(CAST({f} AS DOUBLE) - m_{f}), 0.5) * 1.4826 AS d_{f}, stddev_samp({f}) AS s_{f}"
        for f in features
    )
    parts = ", ".join(
        f"coalesce(abs(CAST({f} AS DOUBLE) - m_{f}) / nullif(CASE WHEN d_{f} > 0 THEN d_{f} ELSE s_{f} END, 0), 0.0)"
        for f in features
    )
    return f""", rm AS (SELECT {medians} FROM {relation}),
rs AS (SELECT {spreads} FROM {relation}, rm),
rz AS (SELECT t.*, greatest({parts}, 0.0) AS score FROM {relation} t, rm, rs)
SELECT {show}, round(score + 1e-7, 4) AS score FROM rz WHERE score >= (SELECT quantile_disc(score, 0.99) FROM rz)"""


_ANOMALY_KEYS = "pickup_year, pickup_month, pickup_day_of_week, pickup_hour"


@query(
    "anomalies_hourly",
    f", a AS (SELECT {_ANOMALY_KEYS}, count(*) AS trip_count, avg(fare_amount) AS avg_fare FROM trips GROUP BY ALL)"
    + _robust_sql("a", anomalies.DEMAND_FEATURES, f"{_ANOMALY_KEYS}, trip_count, round(avg_fare + 1e-7, 4) AS avg_fare"),
)
def _(spark, d):
    hourly = settled(T.temporal_hourly_stats(trips(spark, d)))
    return anomalies.demand_anomalies(hourly).select(*T.HOURLY_KEYS, "trip_count", "avg_fare", "score")


@query(
    "anomalies_routes",
    f""", a AS (SELECT {_ROUTE}, pickup_year, pickup_month, count(*) AS trip_count, avg(trip_distance) AS avg_distance,
  avg(trip_duration_minutes) AS avg_duration FROM trips GROUP BY ALL HAVING count(*) >= {SLOW_ROUTE_TRIPS})"""
    + _robust_sql(
        "a",
        anomalies.ROUTE_FEATURES,
        f"{_ROUTE}, pickup_year, pickup_month, trip_count, round(avg_distance + 1e-7, 4) AS avg_distance,"
        " round(avg_duration + 1e-7, 4) AS avg_duration",
    ),
)
def _(spark, d):
    routes = settled(T.route_pairs_top(trips(spark, d), min_trips=SLOW_ROUTE_TRIPS))
    return anomalies.route_anomalies(routes).select(
        *T.ROUTE_MONTH_KEYS, "trip_count", "avg_distance", "avg_duration", "score"
    )


@query("anomalies_hourly_forest")
def _(spark, d):
    hourly = settled(T.temporal_hourly_stats(trips(spark, d)))
    return anomalies.demand_anomalies(hourly, method="forest").select(*T.HOURLY_KEYS, "trip_count", "avg_fare", "score")


# ---- forecast -----------------------------------------------------------------------

_COARSE_ZONE = ["zone_lat", "zone_lon"]


def _zone_series(spark, d) -> DataFrame:
    zoned = trips(spark, d).withColumns(
        {"zone_lat": C.grid("pickup_latitude", 1), "zone_lon": C.grid("pickup_longitude", 1)}
    )
    return settled(forecast.hourly_demand(zoned, _COARSE_ZONE))


def _city_series(spark, d) -> DataFrame:
    return settled(forecast.hourly_demand(trips(spark, d)))


def _naive_sql(demand_cte: str, zones: str) -> str:
    keys = f"{zones}, " if zones else ""
    match = " AND ".join(
        [f"s.{z} = dm.{z}" for z in zones.split(", ") if z] + ["dm.hour_start = s.hour_start - INTERVAL 168 HOUR"]
    )
    shown = "".join(f"s.{z}, " for z in zones.split(", ") if z)
    return f"""{demand_cte},
zs AS (SELECT DISTINCT {keys}1 AS one FROM dm),
s AS (SELECT {keys}CAST(a AS INTEGER) AS hour_ahead, (SELECT max(hour_start) FROM dm) + to_hours(a) AS hour_start
  FROM zs, range(1, 25) r(a))
SELECT {shown}s.hour_ahead, {ts_text("s.hour_start", "hour_start")}, coalesce(dm.trip_count, 0) AS predicted_trips
FROM s LEFT JOIN dm ON {match}"""


@query(
    "seasonal_naive_forecast",
    _naive_sql(
        """, dm AS (SELECT round(pickup_latitude, 1) AS zone_lat, round(pickup_longitude, 1) AS zone_lon,
  date_trunc('hour', tpep_pickup_datetime) AS hour_start, count(*) AS trip_count FROM trips GROUP BY 1, 2, 3)""",
        "zone_lat, zone_lon",
    ),
)
def _(spark, d):
    return forecast.seasonal_naive_forecast(_zone_series(spark, d), _COARSE_ZONE)


@query(
    "events_seasonal_naive",
    _naive_sql(
        "WITH dm AS (SELECT date_trunc('hour', ts) AS hour_start, count(*) AS trip_count FROM events GROUP BY 1)", ""
    ),
    base=None,
)
def _(spark, d):
    return forecast.seasonal_naive_forecast(settled(forecast.hourly_demand(table(spark, d, "events"), ts="ts")))


@query(
    "recent_demand",
    """, dm AS (SELECT date_trunc('hour', tpep_pickup_datetime) AS hour_start, count(*) AS trip_count FROM trips GROUP BY 1),
s AS (SELECT (SELECT max(hour_start) FROM dm) - to_hours(b) AS hour_start FROM range(0, 168) r(b))
SELECT """
    + ts_text("s.hour_start", "hour_start")
    + """, coalesce(dm.trip_count, 0) AS trip_count FROM s LEFT JOIN dm ON dm.hour_start = s.hour_start""",
)
def _(spark, d):
    return forecast.recent_demand(_city_series(spark, d))


_SPAN = ("1996-01-01 00:00:00", "1996-04-01 00:00:00")
_SPAN_SQL = """, dm AS (SELECT date_trunc('hour', tpep_pickup_datetime) AS hour_start, count(*) AS trip_count FROM trips
  WHERE tpep_pickup_datetime >= '%s' AND tpep_pickup_datetime < '%s' GROUP BY 1)""" % _SPAN
_LAST_SQL = f"TIMESTAMP '{_SPAN[1]}' - INTERVAL 1 HOUR"


@query(
    "demand_lags",
    _SPAN_SQL
    + f""", sp AS (SELECT unnest(generate_series((SELECT min(hour_start) FROM dm), {_LAST_SQL} + INTERVAL 24 HOUR,
    INTERVAL 1 HOUR)) AS hour_start),
f AS (SELECT hour_start, CASE WHEN hour_start <= {_LAST_SQL} THEN CAST(coalesce(trip_count, 0) AS DOUBLE) END AS trip_count
  FROM sp LEFT JOIN dm USING (hour_start)),
l AS (SELECT *, {", ".join(f"lag(trip_count, {n}) OVER (ORDER BY hour_start) AS lag_{n}" for n in forecast.LAGS)} FROM f)
SELECT {ts_text("hour_start", "hour_start")}, trip_count, lag_24, lag_48, lag_168,
  CAST(date_diff('hour', {_LAST_SQL}, hour_start) AS INTEGER) AS hour_ahead FROM l WHERE lag_168 IS NOT NULL""",
)
def _(spark, d):
    """Spine and lags of a bounded series: what the regression is fitted to."""
    return forecast.with_lags(_city_series(spark, d), start=_SPAN[0], end=_SPAN[1]).drop("last")


@query(
    "seasonal_naive_range",
    _SPAN_SQL
    + f""", s AS (SELECT CAST(a AS INTEGER) AS hour_ahead, {_LAST_SQL} + to_hours(a) AS hour_start FROM range(1, 25) r(a))
SELECT s.hour_ahead, {ts_text("s.hour_start", "hour_start")}, coalesce(dm.trip_count, 0) AS predicted_trips
FROM s LEFT JOIN dm ON dm.hour_start = s.hour_start - INTERVAL 168 HOUR""",
)
def _(spark, d):
    return forecast.seasonal_naive_forecast(_city_series(spark, d), start=_SPAN[0], end=_SPAN[1])


@query(
    "recent_demand_range",
    _SPAN_SQL
    + f""", s AS (SELECT {_LAST_SQL} - to_hours(b) AS hour_start FROM range(0, 168) r(b))
SELECT {ts_text("s.hour_start", "hour_start")}, coalesce(dm.trip_count, 0) AS trip_count
FROM s LEFT JOIN dm ON dm.hour_start = s.hour_start""",
)
def _(spark, d):
    return forecast.recent_demand(_city_series(spark, d), start=_SPAN[0], end=_SPAN[1])


def _ridge_sql(size: int, regularization: float) -> str:
    """CTEs from ``variances`` (v), ``label_deviation`` (d) and ``related`` (i, j, r), the
    correlations of features 1 to ``size`` and (j = size + 1) the label, to ``standard``
    (i, b): the coefficients by Gauss-Jordan elimination."""
    return f"""
cells AS (SELECT i, j, CASE WHEN i = j THEN 1 + {regularization} / d ELSE coalesce(r, 0.0) END AS r FROM related, label_deviation),
matrix AS (SELECT list(line ORDER BY i) AS m FROM (SELECT i, list(r ORDER BY j) AS line FROM cells GROUP BY i)),
steps(k, m) AS (SELECT 1, m FROM matrix UNION ALL
  SELECT k + 1, list_transform(m, lambda line, i: list_transform(line, lambda x, j:
    CASE WHEN i = k THEN x / m[k][k] ELSE x - line[k] * m[k][j] / m[k][k] END)) FROM steps WHERE k <= {size}),
standard AS (SELECT i, m[i][{size + 1}] * d AS b FROM (SELECT m, unnest(range(1, {size + 1})) AS i FROM steps WHERE k = {size + 1}), label_deviation)"""


def _regression_sql(zones: str, result: str, until: int = 0) -> str:
    """Spine, lags and the regression on the hours up to ``until`` hours from the end, by
    normal equations; then ``result`` from ``l`` (rows, predicted)."""
    keys = f"{zones}, " if zones else ""
    grid = {"zone_lat": "round(pickup_latitude, 1)", "zone_lon": "round(pickup_longitude, 1)"}
    shown = "".join(f"{grid[z]} AS {z}, " for z in zones.split(", ") if z)
    using, by = (f"{keys}hour_start", f"PARTITION BY {zones} " if zones else "")
    lags = [f"lag_{n}" for n in forecast.LAGS]
    seen = [*lags, "trip_count"]
    return f"""WITH RECURSIVE {TRIPS_SQL.strip()}, dm AS (SELECT {shown}date_trunc('hour', tpep_pickup_datetime) AS hour_start,
  count(*) AS trip_count FROM trips GROUP BY ALL),
ends AS (SELECT max(hour_start) AS last FROM dm),
sp AS (SELECT {keys}unnest(generate_series(first, last + INTERVAL 24 HOUR, INTERVAL 1 HOUR)) AS hour_start
  FROM (SELECT {keys}min(hour_start) AS first FROM dm GROUP BY ALL), ends),
f AS (SELECT {keys}hour_start, date_diff('hour', last, hour_start) AS hour_ahead,
    CASE WHEN hour_start <= last THEN CAST(coalesce(trip_count, 0) AS DOUBLE) END AS trip_count
  FROM sp LEFT JOIN dm USING ({using}), ends),
l0 AS (SELECT *, hour(hour_start) AS h, dayofweek(hour_start) + 1 AS d,
    {", ".join(f"lag(trip_count, {n}) OVER ({by}ORDER BY hour_start) AS lag_{n}" for n in forecast.LAGS)} FROM f),
l1 AS (SELECT * FROM l0 WHERE lag_168 IS NOT NULL),
g AS (SELECT h, d, count(*) AS n, [{", ".join(f"sum({c})" for c in seen)}] AS own,
    [{", ".join("[" + ", ".join(f"sum({x} * {y})" for y in seen) + "]" for x in seen)}] AS two FROM l1 WHERE hour_ahead <= {until} GROUP BY h, d),
v AS (SELECT h, d, i, CASE WHEN i <= 3 THEN i WHEN i = 33 THEN 4 ELSE 0 END AS a,
    CASE WHEN i BETWEEN 4 AND 26 AND h = i - 3 OR i BETWEEN 27 AND 32 AND d = i - 25 THEN 1 ELSE 0 END AS flag
  FROM (SELECT h, d, unnest(range(1, 34)) AS i FROM g)),
total AS (SELECT sum(n) AS n FROM g),
means AS (SELECT i, sum(CASE WHEN a > 0 THEN own[a] ELSE n * flag END) / (SELECT n FROM total) AS m FROM v JOIN g USING (h, d) GROUP BY i),
spreads AS (SELECT i, j, p / (SELECT n FROM total) - x.m * y.m AS c FROM (SELECT x.i, y.i AS j, sum(CASE
    WHEN x.a > 0 AND y.a > 0 THEN two[x.a][y.a] WHEN x.a > 0 THEN own[x.a] * y.flag WHEN y.a > 0 THEN own[y.a] * x.flag
    ELSE n * x.flag * y.flag END) AS p FROM v x JOIN v y USING (h, d) JOIN g USING (h, d) GROUP BY ALL)
  JOIN means x USING (i) JOIN (SELECT i AS j, m FROM means) y USING (j)),
scales AS (SELECT i, sqrt(c) AS s FROM spreads WHERE i = j),
label_deviation AS (SELECT s AS d FROM scales WHERE i = 33),
related AS (SELECT i, j, CASE WHEN x.s > 1e-9 AND y.s > 1e-9 THEN c / (x.s * y.s) END AS r FROM spreads
  JOIN scales x USING (i) JOIN (SELECT i AS j, s FROM scales) y USING (j) WHERE i <= 32),
{_ridge_sql(32, 0.01)},
line AS (SELECT i, CASE WHEN s > 1e-9 THEN b / s ELSE 0.0 END AS w FROM standard JOIN scales USING (i)),
base AS (SELECT (SELECT m FROM means WHERE i = 33) - sum(w * m) AS intercept FROM line JOIN means USING (i)),
l AS (SELECT l1.*, greatest(0.0, intercept + coalesce(hw.w, 0) + coalesce(dw.w, 0)
    + {" + ".join(f"lag_{n} * (SELECT w FROM line WHERE i = {i + 1})" for i, n in enumerate(forecast.LAGS))}) AS predicted
  FROM l1 CROSS JOIN base LEFT JOIN line hw ON hw.i = l1.h + 3 AND l1.h > 0 LEFT JOIN line dw ON dw.i = l1.d + 25 AND l1.d > 1)
{result}"""


def _forecast_sql(zones: str) -> str:
    keys = f"{zones}, " if zones else ""
    return _regression_sql(zones, f"""SELECT {keys}CAST(hour_ahead AS INTEGER) AS hour_ahead, {ts_text("hour_start", "hour_start")},
  {r4("predicted", "predicted_trips")}, {r4("lag_168", "naive_trips")} FROM l WHERE hour_ahead > 0""")


@query("demand_forecast", _forecast_sql(""), base=None)
def _(spark, d):
    return forecast.demand_forecast(_city_series(spark, d))


@query("demand_forecast_by_zone", _forecast_sql("zone_lat, zone_lon"), base=None)
def _(spark, d):
    return forecast.demand_forecast(_zone_series(spark, d), _COARSE_ZONE)


@query(
    "forecast_backtest",
    _regression_sql("", f"""SELECT {r4("avg(abs(trip_count - predicted))", "model_mae")}, {r4("avg(abs(trip_count - lag_168))", "naive_mae")},
  count(*) AS test_hours FROM l WHERE hour_ahead > -168 AND hour_ahead <= 0""", until=-forecast.WEEK),
    base=None,
)
def _(spark, d):
    return forecast.backtest(_city_series(spark, d))


# ---- clusters and models --------------------------------------------------------------


def _learning_trips(spark, d) -> DataFrame:
    """Cleaned trips as a stored table, as a fit over many passes would find them.

    The test tables are one file each, so the copy is dealt out over all cores.
    """
    columns = dict.fromkeys([*models.FEATURES, models.LABEL, C.PICKUP, "trip_duration_minutes"])
    return settled(sampling.spread(trips(spark, d).select(*columns), spark.sparkContext.defaultParallelism))


def _kmeans_sql(relation: str, columns: list[str], k: int, scaled: bool) -> str:
    """CTEs from a relation to ``labelled``: its rows with ``c``, the number of their
    cluster, by the same starts and rounds."""
    unit = ", ".join(f"CAST(CAST(round({c} / {clusters.HASH_UNIT}) AS BIGINT) AS VARCHAR)" for c in columns)
    means = ", ".join((f"avg({c}) AS m{i}, coalesce(nullif(stddev_samp({c}), 0), 1.0) AS s{i}" if scaled else f"0.0 AS m{i}, 1.0 AS s{i}") for i, c in enumerate(columns))
    point = ", ".join(f"(CAST({c} AS DOUBLE) - m{i}) / s{i}" for i, c in enumerate(columns))
    away = " + ".join(f"(p[{i + 1}] - z[{i + 1}]) * (p[{i + 1}] - z[{i + 1}])" for i in range(len(columns)))
    new = ", ".join(f"avg(p[{i + 1}])" for i in range(len(columns)))
    return f"""
scaling AS MATERIALIZED (SELECT {means}{f" FROM {relation}" if scaled else ""}),
points AS MATERIALIZED (SELECT *, row_number() OVER () AS id, [{point}] AS p, md5(concat_ws('|', '{sampling.SEED}', {unit})) AS hash FROM {relation}, scaling),
places AS MATERIALIZED (SELECT id, p FROM points),
starts AS (SELECT row_number() OVER (ORDER BY hash) - 1 AS c, p AS z FROM (
  SELECT hash, any_value(p) AS p FROM points GROUP BY hash ORDER BY hash LIMIT {k})),
rounds(nth, c, z) AS (SELECT 0, c, z FROM starts UNION ALL
  SELECT r.nth + 1, r.c, coalesce(n.z, r.z) FROM rounds r LEFT JOIN (SELECT near.c AS c, [{new}] AS z
    FROM (SELECT id, any_value(p) AS p, min({{'away': {away}, 'c': c}}) AS near FROM rounds CROSS JOIN places GROUP BY id) GROUP BY near.c) n ON n.c = r.c
  WHERE r.nth < {clusters.MAX_ITERATIONS}),
numbered AS (SELECT id, min({{'away': {away}, 'c': c}}) AS near FROM places CROSS JOIN (SELECT c, z FROM rounds WHERE nth = (SELECT max(nth) FROM rounds)) GROUP BY id),
labelled AS (SELECT points.*, CAST(near.c AS INTEGER) AS c FROM points JOIN numbered USING (id))"""


@query(
    "spatial_clusters",
    f"""WITH RECURSIVE {TRIPS_SQL.strip()}, {_kmeans_sql("trips", ["pickup_latitude", "pickup_longitude"], 20, False)}
SELECT c AS cluster_id, {N}, {r4("avg(pickup_latitude)", "latitude")}, {r4("avg(pickup_longitude)", "longitude")},
  {r4("avg(fare_amount)", "avg_fare")} FROM labelled GROUP BY c""",
    base=None,
)
def _(spark, d):
    return clusters.spatial_clusters(_learning_trips(spark, d))


def _weighted(df: DataFrame, weight: str, means: list[str]) -> DataFrame:
    """Rows and weighted means of a clustering, which are those of all clustered rows."""
    total = F.sum(weight)
    return df.agg(total.alias("rows"), *[(F.sum(F.col(c) * F.col(weight)) / total).alias(c) for c in means])


@query(
    "spatial_cluster_totals",
    f"""
SELECT count(*) AS rows, {r4("avg(pickup_latitude)", "latitude")}, {r4("avg(pickup_longitude)", "longitude")},
  {r4("avg(fare_amount)", "avg_fare")} FROM trips""",
)
def _(spark, d):
    found = clusters.spatial_clusters(_learning_trips(spark, d))
    return _weighted(found, "trip_count", ["latitude", "longitude", "avg_fare"])


@query(
    "trip_segment_totals",
    f"""
SELECT count(*) AS rows, {r4("avg(fare_amount)", "avg_fare")}, {r4("avg(trip_distance)", "avg_distance")},
  {r4("avg(trip_duration_minutes)", "avg_duration")} FROM trips""",
)
def _(spark, d):
    found = clusters.trip_segments(_learning_trips(spark, d))
    return _weighted(found, "customer_count", ["avg_fare", "avg_distance", "avg_duration"])


@query(
    "trip_segments",
    f"""WITH RECURSIVE {TRIPS_SQL.strip()}, {_kmeans_sql("trips", ["fare_amount", "trip_distance", "trip_duration_minutes"], 5, True)}
SELECT c AS segment, count(*) AS customer_count, {r4("avg(fare_amount)", "avg_fare")}, {r4("avg(trip_distance)", "avg_distance")},
  {r4("avg(trip_duration_minutes)", "avg_duration")} FROM labelled GROUP BY c""",
    base=None,
)
def _(spark, d):
    return clusters.trip_segments(_learning_trips(spark, d))


_SEGMENTS_SQL = f""", f AS ({_FARES_SQL}), tp AS ({_tips_sql("payment_type, pickup_hour, {bucket}", S.DISTANCE_5WAY, False)})
SELECT f.*, coalesce(tp.high_tipper_rate, 0.0) AS high_tipper_rate, coalesce(tp.no_tip_rate, 0.0) AS no_tip_rate
FROM f LEFT JOIN tp ON f.payment_type = tp.payment_type AND f.pickup_hour = tp.pickup_hour
  AND f.distance_bucket = tp.distance_bucket"""


@query("segment_inputs", _SEGMENTS_SQL)
def _(spark, d):
    return clusters.segment_inputs(trips(spark, d))


@query("segment_inputs_rollup", _SEGMENTS_SQL)
def _(spark, d):
    t = trips(spark, d)
    return state.segment_inputs(state.fare_state(t), state.tip_state(t))


@query(
    "customer_segments",
    "WITH RECURSIVE " + re.sub(r"round\((.+?) \+ 1e-07, 4\) AS", r"(\1) AS", f"{TRIPS_SQL.strip()}{_SEGMENTS_SQL.replace('SELECT f.*', ', si AS (SELECT f.*', 1)})")
    + f""", {_kmeans_sql("si", clusters.SEGMENT_FEATURES, 4, True)}
SELECT c AS segment, {", ".join(r4(f"avg({c})", c) for c in clusters.SEGMENT_FEATURES if c != "total_revenue")},
  {r4("sum(total_revenue)", "total_revenue")}, count(*) AS group_count FROM labelled GROUP BY c""",
    base=None,
)
def _(spark, d):
    return clusters.customer_segments(settled(clusters.segment_inputs(trips(spark, d))))


_LEARNING_SQL = f""", r AS (SELECT *, CAST('0x' || substr(md5(concat_ws('|', '{sampling.SEED}',
    CAST(tpep_pickup_datetime AS VARCHAR), coalesce(CAST(passenger_count AS VARCHAR), ''))), 1, 4) AS INTEGER)
    >= {round(sampling.TRAIN_SHARE * 65536)} AS is_test
  FROM trips WHERE fare_amount > 0 AND trip_distance > 0 AND passenger_count IS NOT NULL),
m AS (SELECT avg(fare_amount) AS mean_fare FROM r WHERE NOT is_test)"""


@query(
    "fare_split",
    _LEARNING_SQL
    + f"""
SELECT count(*) FILTER (WHERE NOT is_test) AS training_rows, count(*) FILTER (WHERE is_test) AS test_rows,
  {r4("any_value(mean_fare)", "mean_fare")},
  {r4("sqrt(avg((fare_amount - mean_fare) * (fare_amount - mean_fare)) FILTER (WHERE is_test))", "baseline_rmse")}
FROM r, m""",
)
def _(spark, d):
    """What every model learns from and must beat."""
    return models.split_report(models.learning_rows(trips(spark, d)))


@query(
    "fare_models",
    _LEARNING_SQL
    + f"""
SELECT name AS model, count(*) FILTER (WHERE NOT is_test) AS training_rows, count(*) FILTER (WHERE is_test) AS test_rows,
  CAST(NULL AS VARCHAR) AS error, true AS beats_mean
FROM r, (VALUES {", ".join(f"('{m}')" for m in models.MODEL_FOLDERS)}) v(name) GROUP BY 1""",
)
def _(spark, d):
    """All three kinds with the library's settings, trained on one stored table: each
    must be trained without an error and beat the mean on the held-out side."""
    found = models.metrics_frame(spark, models.train_all(_learning_trips(spark, d)))
    return found.select("model", "training_rows", "test_rows", "error", (F.col("r2") > 0).alias("beats_mean"))


@query("fare_model_random_forest")
def _(spark, d):
    return models.metrics_frame(spark, {"m": models.train(_learning_trips(spark, d), "random_forest")})


@query("fare_model_gbt")
def _(spark, d):
    return models.metrics_frame(spark, {"m": models.train(_learning_trips(spark, d), "gbt")})


@query("fare_model_linear")
def _(spark, d):
    return models.metrics_frame(spark, {"m": models.train(_learning_trips(spark, d), "linear_regression")})


def _fare_line_sql(result: str) -> str:
    """The linear model by its normal equations, then ``result``."""
    pairs = [(i, j) for i in range(1, 11) for j in range(1, 12)]
    names = [*models.FEATURES, models.LABEL]
    related = " UNION ALL ".join(f"SELECT {i} AS i, {j} AS j, corr({names[i - 1]}, {names[j - 1]}) AS r FROM t" for i, j in pairs if i < j)
    # each pair once, mirrored below the diagonal
    return f"WITH RECURSIVE {TRIPS_SQL.strip()}" + _LEARNING_SQL + f""",
t AS (SELECT {", ".join(names)} FROM r WHERE NOT is_test),
label_deviation AS (SELECT stddev_pop(fare_amount) AS d, avg(fare_amount) AS mean FROM t),
upper AS ({related}),
related AS (SELECT * FROM upper UNION ALL SELECT j, i, r FROM upper WHERE j <= 10 UNION ALL SELECT i, i, 1.0 FROM (SELECT unnest(range(1, 11)) AS i)),
{_ridge_sql(10, 0.01)},
scales AS ({" UNION ALL ".join(f"SELECT {i + 1} AS i, '{f}' AS feature, stddev_pop({f}) AS s, avg({f}) AS mean FROM t" for i, f in enumerate(models.FEATURES))}),
line AS (SELECT feature, b, scales.mean, CASE WHEN s > 0 THEN b / s ELSE 0.0 END AS coefficient FROM scales JOIN standard USING (i)),
base AS (SELECT (SELECT mean FROM label_deviation) - sum(coefficient * mean) AS intercept FROM line)
{result}"""


_COEFFICIENTS_SQL = _fare_line_sql(f"""
SELECT feature, {r4("coefficient", "coefficient")}, {r4("abs(b) / sum(abs(b)) OVER ()", "importance")} FROM line
UNION ALL SELECT 'intercept', {r4("intercept", "coefficient")}, NULL FROM base""")

_PREDICTED = " + ".join(f"(SELECT coefficient FROM line WHERE feature = '{f}') * {f}" for f in models.FEATURES)


@query("fare_line_coefficients", _COEFFICIENTS_SQL, base=None)
def _(spark, d):
    """The linear model solved from the moment state."""
    line, _ = moments.fare_line(state.moment_state(trips(spark, d)))
    return moments.fare_coefficients(spark, line)


@query(
    "fare_line_metrics",
    _fare_line_sql(f""", tested AS (SELECT fare_amount, (SELECT intercept FROM base) + {_PREDICTED} AS p FROM r WHERE is_test)
SELECT 'linear_regression' AS model, (SELECT count(*) FROM t) AS training_rows, count(*) AS test_rows,
  {r4("sqrt(avg((fare_amount - p) * (fare_amount - p)))", "rmse")},
  {r4("1 - avg((fare_amount - p) * (fare_amount - p)) / var_pop(fare_amount)", "r2")} FROM tested"""),
    base=None,
)
def _(spark, d):
    """Its held-out error, from the moments of the test side."""
    _, measured = moments.fare_line(state.moment_state(trips(spark, d)))
    return models.metrics_frame(spark, {"line": measured}).select("model", "training_rows", "test_rows", "rmse", "r2")


@query("correlations_rollup", ORACLES["correlations"].removeprefix(f"WITH {TRIPS_SQL.strip()}"))
def _(spark, d):
    return moments.correlations(state.moment_state(trips(spark, d)))


@query("market_share_rollup", ORACLES["market_share"].removeprefix(f"WITH {TRIPS_SQL.strip()}"))
def _(spark, d):
    return moments.market_share(state.moment_state(trips(spark, d)))


@query("feature_importance")
def _(spark, d):
    return models.feature_importance(spark, models.train(_learning_trips(spark, d), "linear_regression").model)


@query("fare_scores")
def _(spark, d):
    """Fares predicted for every trip by a saved and reloaded model, averaged per hour."""
    t = _learning_trips(spark, d)
    folder = shared_dir(spark, "models")
    models.save(models.train(t, "linear_regression"), folder)
    scored = models.score_fares(t, models.load(spark, folder))
    return scored.groupBy("pickup_hour").agg(
        F.count(F.lit(1)).alias("trip_count"),
        F.avg("fare_amount").alias("avg_fare"),
        F.avg("predicted_fare").alias("avg_predicted_fare"),
    )


@query(
    "fare_score_hours",
    f"\nSELECT pickup_hour, {N}, {r4('avg(fare_amount)', 'avg_fare')} FROM trips GROUP BY 1",
)
def _(spark, d):
    """Trips that a saved and reloaded model scored, per hour: every trip gets a fare."""
    return QUERIES["fare_scores"](spark, d).where("avg_predicted_fare IS NOT NULL").drop("avg_predicted_fare")


# ---- incremental and streaming loads ------------------------------------------------------


def _two_loads(spark, d) -> TripStore:
    """A store after two loads, the second of them applied twice."""
    store = TripStore(shared_dir(spark, "store"))
    raw = raw_trips(spark, d).withColumn("load_id", F.concat(F.lit("vendor-"), F.col("VendorID").cast("string")))
    for load in ("vendor-1", "vendor-2", "vendor-2"):
        incremental.apply_load(spark, store, raw.where(F.col("load_id") == load))
    return store


@query("incremental_merge", _FARES_SQL)
def _(spark, d):
    """The fare table after two loads, the second of them applied twice."""
    return _two_loads(spark, d).table(spark, "economic_fare_analysis")


def _loaded(spark, d) -> TripStore:
    """All trips through the CSV files of two folders, one load after the other, into a
    store of its own."""
    drop, store = shared_dir(spark, "drop"), TripStore(shared_dir(spark, "store"))
    raw = raw_trips(spark, d)
    for vendor in (1, 2):
        source.export_csv(raw.where(F.col("VendorID") == vendor), f"{drop}/{vendor}")
    for vendor in (1, 2):
        incremental.load_csv(spark, store, f"{drop}/{vendor}")
    return store


def _loaded_table(name: str, sql: str, table_name: str, **options) -> None:
    @query(name, sql)
    def _(spark, d):
        return _loaded(spark, d).table(spark, table_name, **options)


_loaded_table("incremental_hourly", _HOURLY_SQL, "temporal_hourly_stats")
_loaded_table("incremental_zones", _ZONES_SQL, "geospatial_zone_stats")
_loaded_table("incremental_routes", _routes_sql(SLOW_ROUTE_TRIPS), "route_pairs_top", route_min_trips=SLOW_ROUTE_TRIPS)
_loaded_table("incremental_airports", ORACLES["airport_analysis"].removeprefix(f"WITH {TRIPS_SQL.strip()}"), "airport_analysis")
_loaded_table("incremental_summary", _summary_sql(), "summary_stats")


@query("stored_cleaning_report", ORACLES["clean_trips_report"], base=None)
def _(spark, d):
    """The cleaning report of a store after two loads, from the figures noted with them."""
    return reports.cleaning_report(spark, _two_loads(spark, d))


@query("stored_rows_per_month", _ROWS_PER_MONTH)
def _(spark, d):
    """Rows per month of a store after the loads of two folders, without reading trips."""
    return reports.rows_per_month(spark, _loaded(spark, d))


# pages of a store: order, direction, page, its size, year
_STORED_PAGES = [
    ("trip_distance", "asc", 151, 100, None),
    (C.PICKUP, "desc", 9, 250, None),
    ("tip_amount", "asc", 40, 60, None),
    ("trip_duration_minutes", "desc", 4, 70, 1997),
]


@query(
    "stored_pages",
    "".join(
        f""", p{i} AS (SELECT * FROM trips WHERE {f"pickup_year = {year}" if year else "true"}
  ORDER BY {_page_order(first, direction)} LIMIT {size} OFFSET {(nth - 1) * size})"""
        for i, (first, direction, nth, size, year) in enumerate(_STORED_PAGES)
    )
    + "".join(f"{' UNION ALL' if i else ''} SELECT {i} AS nth, {_PAGE_SQL} FROM p{i}" for i in range(len(_STORED_PAGES))),
)
def _(spark, d):
    """Pages of a store after two loads, found from its counts per value range."""
    store = _two_loads(spark, d)
    found = [
        pages.page(spark, store, nth, size, first, direction, year, rest_rows=500).withColumn("nth", F.lit(i))
        for i, (first, direction, nth, size, year) in enumerate(_STORED_PAGES)
    ]
    return reduce(DataFrame.union, found)


_SHARES = [0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99]


@query(
    "sketch_quantiles",
    f"""
SELECT measure, share, (SELECT count(*) FROM trips) AS n, true AS within
FROM (VALUES {", ".join(f"('{name}')" for name in ("minutes", "fare_per_mile", "miles_per_hour", "tip_percent"))}) m(measure),
  (VALUES {", ".join(f"(CAST({p} AS DOUBLE))" for p in _SHARES)}) s(share)""",
)
def _(spark, d):
    """Quantiles from the merged sketches of all months: do their true ranks keep to the bound?"""
    t = trips(spark, d)
    return sketches.checked(t, sketches.quantiles(state.sketch_state(t), _SHARES))


@query("repaired_load_hourly", _HOURLY_SQL)
def _(spark, d):
    """Files with badly typed cells load whole."""
    drop, store = shared_dir(spark, "drop"), TripStore(shared_dir(spark, "store"))
    source.export_csv(_odd_texts(spark, d), drop)
    incremental.load_csv(spark, store, drop, repair=True)
    return store.table(spark, "temporal_hourly_stats")


@query("incremental_fare_line", _COEFFICIENTS_SQL, base=None)
def _(spark, d):
    """The linear model after two loads, from their merged moments."""
    line, _ = moments.fare_line(_loaded(spark, d).state(spark, "moments"))
    return moments.fare_coefficients(spark, line)


@query("advanced_revenue_windows", ORACLES["revenue_windows"].removeprefix(f"WITH {TRIPS_SQL.strip()}"))
def _(spark, d):
    """One of the six further analyses of a store, read back from its JSON result."""
    store = _loaded(spark, d)
    batch.run_advanced(spark, store, route_min_trips=SLOW_ROUTE_TRIPS)
    kept = "pickup_day_of_week int, pickup_hour int, total_revenue double"
    return spark.read.schema(kept).json(f"{store.root}/results/revenue_optimization")


# analysis: its own query, and the two columns of it that are shown
_ADVANCED = {
    "surge_hours": ("demand_surge", "trip_count", "z_score"),
    "surge_zones": ("hot_zones", "trip_count", "avg_fare"),
    "route_optimization": ("inefficient_routes", "trip_count", "minutes_per_mile"),
    "revenue_optimization": ("revenue_windows", "pickup_hour", "total_revenue"),
    "customer_segments": ("customer_segments", "group_count", "total_revenue"),
    "demand_anomalies": ("anomalies_hourly", "trip_count", "score"),
    "demand_forecast": ("demand_forecast", "hour_ahead", "predicted_trips"),
    "demand_history": ("recent_demand", "trip_count", "NULL"),
}


@query(
    "advanced_analyses",
    "\nUNION ALL ".join(
        f"SELECT '{shown}' AS analysis, CAST({count} AS BIGINT) AS n, CAST({value} AS DOUBLE) AS value FROM ({ORACLES[name]})"
        for shown, (name, count, value) in _ADVANCED.items()
    ),
    base=None,
)
def _(spark, d):
    """All further analyses of a store by one call, each read back from its JSON rows."""
    store = _loaded(spark, d)
    batch.run_advanced(spark, store, route_min_trips=SLOW_ROUTE_TRIPS)
    parts = []
    for shown, (_, count, value) in _ADVANCED.items():
        kept = f"{count} long" + ("" if value == "NULL" else f", {value} double")
        found = spark.read.schema(kept).json(f"{store.root}/results/{shown}")
        parts.append(found.selectExpr(f"'{shown}' AS analysis", f"{count} AS n", f"CAST({value} AS DOUBLE) AS value"))
    return reduce(DataFrame.union, parts)


@query("run_batch", _BY_HOUR)
def _(spark, d):
    """CSV drops to results and models in one call; a second run, which analyses again
    without training, adds nothing."""
    drop, root = shared_dir(spark, "drop"), shared_dir(spark, "batch")
    source.export_csv(raw_trips(spark, d), drop)
    for stages in (batch.STAGES, ("temporal", "geospatial", "economic")):
        batch.run_batch(spark, drop, root, stages=stages, hotspot_min_trips=1)
    return spark.read.schema("hour int, trip_count long").json(f"{root}/results/trips_by_hour")


@query("stream_merge", _TIPS_SQL)
def _(spark, d):
    """The tip table after a stream took up every CSV file, and ran once more for nothing."""
    drop, store = shared_dir(spark, "drop"), TripStore(shared_dir(spark, "store"))
    checkpoint = shared_dir(spark, "stream")
    source.export_csv(raw_trips(spark, d), drop)
    for _ in range(2):
        arrivals.store_arrivals(spark, drop, store, checkpoint).awaitTermination()
    return store.table(spark, "tip_behavior_analysis")


def _deliver(spark, rows, folder: str) -> None:
    """CSV files of fixed names, in the place of those delivered before: four, or as many as
    tasks read the rows, as they are read. Files delivered before go first, so that the
    folder's content is not held twice."""
    made, read = shared_dir(spark, "made"), rows.rdd.getNumPartitions()
    for path in storage.matching(spark, f"{folder}/part-*.csv"):
        storage.drop_folder(spark, path)
    source.export_csv(rows if read >= 4 else rows.repartition(4, "VendorID", "passenger_count", C.PICKUP), made)
    for path in storage.matching(spark, f"{made}/part-*.csv"):
        storage.move_file(spark, path, f"{folder}/{path.rsplit('/', 1)[1][:10]}.csv")


@query("stream_corrected", _TIPS_SQL)
def _(spark, d):
    """The tip table after a stream took up files with wrong tips and a payment type
    missing, and again after the same files were corrected."""
    drop, store = shared_dir(spark, "drop"), TripStore(shared_dir(spark, "store"))
    checkpoint, raw = shared_dir(spark, "stream"), raw_trips(spark, d)
    wrong = raw.where("payment_type <> 2").withColumn("tip_amount", F.col("tip_amount") + 1)
    for delivered in (wrong, raw):
        _deliver(spark, delivered, drop)
        arrivals.store_arrivals(spark, drop, store, checkpoint).awaitTermination()
    return store.table(spark, "tip_behavior_analysis")
