from datetime import datetime, timedelta

import pytest

from conftest import rows, trip
from curbline.operators import clean
from curbline.sources import trips as source

START = datetime(2015, 1, 5, 10, 0, 0)


def kept(raw, rows_, **options):
    return clean.clean_trips(raw(rows_), **options).count()


def lasting(minutes):
    return trip(tpep_dropoff_datetime=START + timedelta(minutes=minutes))


LIMITS = [
    # open intervals
    ([lasting(1), lasting(180), lasting(0.5), lasting(181)], 0),
    ([lasting(1 + 1 / 60), lasting(180 - 1 / 60)], 2),
    ([trip(trip_distance=0.1), trip(trip_distance=100.0), trip(trip_distance=0.05)], 0),
    ([trip(trip_distance=0.11), trip(trip_distance=99.99)], 2),
    ([trip(fare_amount=2.5), trip(fare_amount=500.0), trip(fare_amount=-3.0)], 0),
    ([trip(fare_amount=2.51), trip(fare_amount=499.99)], 2),
    # closed intervals
    ([trip(passenger_count=1), trip(passenger_count=6)], 2),
    ([trip(passenger_count=0), trip(passenger_count=7)], 0),
    ([trip(pickup_latitude=40.5), trip(pickup_latitude=40.9)], 2),
    ([trip(pickup_latitude=40.4999), trip(pickup_latitude=40.9001)], 0),
    ([trip(dropoff_longitude=-74.3), trip(dropoff_longitude=-73.7)], 2),
    ([trip(dropoff_longitude=-74.3001), trip(dropoff_longitude=-73.6999)], 0),
]


@pytest.mark.parametrize("rows_,expected", LIMITS)
def test_limits(raw, rows_, expected):
    assert kept(raw, rows_) == expected


@pytest.mark.parametrize(
    "field",
    [
        "tpep_pickup_datetime",
        "tpep_dropoff_datetime",
        "fare_amount",
        "trip_distance",
        "passenger_count",
        "pickup_latitude",
        "pickup_longitude",
        "dropoff_latitude",
        "dropoff_longitude",
    ],
)
def test_missing_value_drops_the_trip(raw, field):
    assert kept(raw, [trip(**{field: None}), trip()]) == 1


def test_missing_tip_becomes_zero(raw):
    assert clean.clean_trips(raw([trip(tip_amount=None)])).first()["tip_amount"] == 0.0


def test_fill_before_filter_keeps_missing_passengers(raw):
    cleaned = clean.clean_trips(raw([trip(passenger_count=None)]), fill_before_filter=True)
    assert cleaned.first()["passenger_count"] == 1


def test_derived_columns(raw):
    night = trip(
        tpep_pickup_datetime=datetime(2015, 12, 31, 23, 59, 30),
        tpep_dropoff_datetime=datetime(2016, 1, 1, 0, 10, 0),
        pickup_latitude=40.7549,
        pickup_longitude=-73.9851,
    )
    row = clean.clean_trips(raw([night])).first()
    assert row["trip_duration_minutes"] == 10.5
    assert (row["pickup_lat_grid"], row["pickup_lon_grid"]) == (40.75, -73.99)
    assert (row["pickup_year"], row["pickup_month"], row["pickup_hour"]) == (2015, 12, 23)
    assert (row["year"], row["month"]) == (2015, 12)
    assert row["pickup_day_of_week"] == 5  # a Thursday


@pytest.mark.parametrize("day,number", [(4, 1), (10, 7)])
def test_sunday_is_one(raw, day, number):
    start = datetime(2015, 1, day, 8)
    t = trip(tpep_pickup_datetime=start, tpep_dropoff_datetime=start + timedelta(minutes=9))
    assert clean.clean_trips(raw([t])).first()["pickup_day_of_week"] == number


def test_clock_change_does_not_stretch_trips(raw):
    # US clocks went forward this night; the session calendar is UTC
    start = datetime(2015, 3, 8, 1, 50)
    t = trip(tpep_pickup_datetime=start, tpep_dropoff_datetime=start + timedelta(minutes=20))
    assert clean.clean_trips(raw([t])).first()["trip_duration_minutes"] == 20.0


def test_report_counts_every_broken_rule(raw):
    data = [trip(), trip(fare_amount=1.0, passenger_count=0), trip(passenger_count=None), trip(trip_distance=200.0)]
    r = clean.clean_report(raw(data)).first()
    assert (r["input_rows"], r["output_rows"], r["dropped_rows"], r["dropped_percent"]) == (4, 1, 3, 75.0)
    assert (r["failed_fare"], r["failed_passengers"], r["failed_distance"], r["failed_duration"]) == (1, 2, 1, 0)


def test_report_of_nothing(raw):
    r = clean.clean_report(raw([])).first()
    assert (r["input_rows"], r["output_rows"], r["dropped_percent"]) == (0, 0, None)


def test_report_agrees_with_cleaning(spark):
    from conftest import SF_SMALL
    from driver_tables.trips_view import raw_trips

    source = raw_trips(spark, SF_SMALL)
    assert clean.clean_report(source).first()["output_rows"] == clean.clean_trips(source).count()


def test_quality_and_rows_per_month(raw):
    cleaned = clean.clean_trips(raw([trip(), trip(fare_amount=20.0)]))
    assert rows(clean.data_quality(cleaned)) == [(0, 0, 0, 12.0, 20.0, 2.5, 2.5)]
    assert rows(source.load_report(cleaned)) == [(2015, 1, 2, 2)]


def test_non_finite_cells_are_missing(raw):
    nan, inf = float("nan"), float("inf")
    data = [trip(), trip(tip_amount=nan), trip(fare_amount=inf), trip(pickup_latitude=nan), trip(tip_amount=-inf)]
    cleaned = clean.clean_trips(raw(data))
    assert sorted(r["tip_amount"] for r in cleaned.collect()) == [0.0, 0.0, 2.0]
    assert clean.clean_report(raw(data)).first()["non_finite_cells"] == 4


def test_other_time_zones_are_refused(spark, raw):
    frame = raw([trip()])
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        with pytest.raises(ValueError, match="UTC"):
            clean.clean_trips(frame)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_one_finite_test_a_column_and_none_where_limits_hold(raw):
    """Limited columns need no test of their own; others have one."""
    plan = clean.clean_trips(raw([trip()]))._jdf.queryExecution().analyzed().toString()
    assert plan.count("Infinity") == len(["extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge", "total_amount"])
    assert "isnan" not in plan


def test_a_limit_that_is_not_finite_still_drops_nan_and_infinity(raw):
    inf = float("inf")
    open_ = {**clean.S.CLEANING_LIMITS, "fare_amount_max": inf, "lat_max": inf}
    odd = [trip(fare_amount=inf), trip(fare_amount=float("nan")), trip(pickup_latitude=inf), trip(dropoff_latitude=float("nan"))]
    assert clean.clean_trips(raw([trip(fare_amount=1e6), *odd]), open_).count() == 1
