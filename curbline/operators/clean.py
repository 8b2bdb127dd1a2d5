"""Cleaning rules, derived columns, and the reports about both."""

from __future__ import annotations

from functools import reduce
from math import isfinite

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from curbline import schema as S
from curbline.functions import columns as C
from curbline.functions.rollup import percent_of
from curbline.session import require_utc

RULES = ["duration", "distance", "fare", "passengers", "pickup_location", "dropoff_location"]
REQUIRED = [C.PICKUP, C.DROPOFF, "fare_amount", "trip_distance"]


def _open(name: str, low, high) -> Column:
    return (F.col(name) > F.lit(low)) & (F.col(name) < F.lit(high))


def rules(limits: dict = S.CLEANING_LIMITS) -> dict[str, Column]:
    """Rule name -> predicate a kept trip satisfies (NULL counts as failing)."""

    def in_city(side: str) -> Column:
        return F.col(f"{side}_latitude").between(limits["lat_min"], limits["lat_max"]) & F.col(
            f"{side}_longitude"
        ).between(limits["lon_min"], limits["lon_max"])

    return {
        "duration": _open("trip_duration_minutes", limits["trip_duration_min"], limits["trip_duration_max"]),
        "distance": _open("trip_distance", limits["trip_distance_min"], limits["trip_distance_max"]),
        "fare": _open("fare_amount", limits["fare_amount_min"], limits["fare_amount_max"]),
        "passengers": F.col("passenger_count").between(
            limits["passenger_count_min"], limits["passenger_count_max"]
        ),
        "pickup_location": in_city("pickup"),
        "dropoff_location": in_city("dropoff"),
    }


def _complete() -> Column:
    return reduce(Column.__and__, [F.col(c).isNotNull() for c in REQUIRED])


def _doubles(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, DoubleType)]


def _finite(name: str) -> Column:
    """One test for both: NaN counts as greater than infinity."""
    return F.abs(name) < float("inf")


def without_non_finite(trips: DataFrame, columns=None) -> DataFrame:
    """NaN and infinite cells as NULL, so that they spoil no mean, order or range."""
    columns = _doubles(trips) if columns is None else columns
    return trips.withColumns({c: F.when(_finite(c), F.col(c)) for c in columns})


def odd_cells(raw: DataFrame) -> Column:
    """How many cells of a row are NaN or infinite."""
    return sum((F.coalesce(~_finite(c), F.lit(False)).cast("int") for c in _doubles(raw)), F.lit(0))


def _bounded(limits: dict) -> set[str]:
    """Columns that the rules hold between finite limits: a cell that is NaN or infinite
    fails them as a missing one does, so it needs no test of its own."""
    limited = {"trip_distance": ["trip_distance"], "fare_amount": ["fare_amount"]}
    limited |= {short: [f"pickup_{full}", f"dropoff_{full}"] for short, full in (("lat", "latitude"), ("lon", "longitude"))}
    return {c for key, names in limited.items() if all(isfinite(limits[f"{key}_{end}"]) for end in ("min", "max")) for c in names}


def with_duration(trips: DataFrame) -> DataFrame:
    return trips.withColumn("trip_duration_minutes", C.trip_minutes())


def with_derived(trips: DataFrame) -> DataFrame:
    """Grid cells, calendar fields and the year/month partition columns."""
    cells = {
        f"{side}_{short}_grid": C.grid(f"{side}_{full}")
        for side in ("pickup", "dropoff")
        for short, full in (("lat", "latitude"), ("lon", "longitude"))
    }
    return trips.withColumns(
        {
            **cells,
            "pickup_hour": F.hour(C.PICKUP),
            "pickup_day_of_week": F.dayofweek(C.PICKUP),
            "pickup_month": F.month(C.PICKUP),
            "pickup_year": F.year(C.PICKUP),
            "year": F.year(C.PICKUP),
            "month": F.month(C.PICKUP),
        }
    )


def _fill_passengers(trips: DataFrame) -> DataFrame:
    return trips.fillna({"passenger_count": 1})


def clean_trips(
    raw: DataFrame, limits: dict = S.CLEANING_LIMITS, fill_before_filter: bool = False
) -> DataFrame:
    """Keep the trips that satisfy every rule and add the derived columns.

    A missing tip becomes 0. A missing passenger count drops the trip, unless
    ``fill_before_filter`` makes it 1 beforehand. NaN and infinite cells count as
    missing. The session's time zone must be UTC, on which calendar fields rest.
    """
    require_utc(raw.sparkSession)
    bounded = _bounded(limits)
    raw = without_non_finite(raw, [c for c in _doubles(raw) if c not in bounded])
    timed = with_duration(_fill_passengers(raw) if fill_before_filter else raw)
    kept = timed.where(reduce(Column.__and__, [*rules(limits).values(), _complete()]))
    return with_derived(kept.withColumn("tip_amount", F.coalesce("tip_amount", F.lit(0.0))))


def clean_report(
    raw: DataFrame, limits: dict = S.CLEANING_LIMITS, fill_before_filter: bool = False
) -> DataFrame:
    """One row: trips in, kept, dropped, percent dropped, failures per rule, and cells
    that were NaN or infinite.

    A trip that breaks several rules is counted under each of them.
    """
    raw = without_non_finite(raw.withColumn("_odd", odd_cells(raw)))
    timed = with_duration(_fill_passengers(raw) if fill_before_filter else raw)
    checks = {name: F.coalesce(rule, F.lit(False)) for name, rule in rules(limits).items()}
    keep = reduce(Column.__and__, checks.values(), _complete())
    counted = timed.agg(
        F.count(F.lit(1)).alias("input_rows"),
        F.count_if(keep).alias("output_rows"),
        *[F.count_if(~ok).alias(f"failed_{name}") for name, ok in checks.items()],
        F.coalesce(F.sum("_odd"), F.lit(0)).alias("non_finite_cells"),
    )
    dropped = F.col("input_rows") - F.col("output_rows")
    return counted.select(
        "input_rows",
        "output_rows",
        dropped.alias("dropped_rows"),
        percent_of(dropped, F.col("input_rows")).alias("dropped_percent"),
        *[f"failed_{name}" for name in checks],
        "non_finite_cells",
    )


def data_quality(trips: DataFrame) -> DataFrame:
    """NULL counts of the critical columns and the range of fare and distance."""
    critical = [C.PICKUP, "fare_amount", "trip_distance"]
    return trips.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in critical],
        F.min("fare_amount").alias("min_fare"),
        F.max("fare_amount").alias("max_fare"),
        F.min("trip_distance").alias("min_distance"),
        F.max("trip_distance").alias("max_distance"),
    )
