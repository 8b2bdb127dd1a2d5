from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows, trip
from curbline.operators import clean, temporal
from curbline.plans import tables as T


def at(day, hour, n=1, month=1):
    start = datetime(2015, month, day, hour)
    return [trip(tpep_pickup_datetime=start, tpep_dropoff_datetime=start + timedelta(minutes=10))] * n


def test_ties_rank_the_earlier_hour_first(raw):
    cleaned = clean.clean_trips(raw(at(5, 9, 2) + at(5, 7, 2) + at(6, 20)))
    assert rows(temporal.peak_hours(cleaned, 2)) == [(7, 2), (9, 2)]
    assert rows(temporal.busiest_quietest(cleaned)) == [(7, 2, 20, 1, 2, 4, 3, 1)]


def test_aggregate_answers_equal_trip_answers(small_trips):
    hourly = T.temporal_hourly_stats(small_trips)
    for ask in (
        lambda df: temporal.trips_by_hour(df, year=1997),
        lambda df: temporal.trips_by_day(df, month=3),
        lambda df: temporal.trips_by_month(df),
        lambda df: temporal.peak_hours(df, 5),
        lambda df: temporal.busiest_quietest(df),
    ):
        assert rows(ask(hourly)) == rows(ask(small_trips))
    for group in ("hour", "day", "month"):
        a, b = rows(temporal.fare_trends(hourly, group)), rows(temporal.fare_trends(small_trips, group))
        assert [r[:-2] for r in a] == [r[:-2] for r in b]
        assert [r[-2:] for r in a] == [pytest.approx(r[-2:]) for r in b]


def test_weekend_and_weekday_make_up_all_trips(small_trips):
    routes = T.route_pairs_top(small_trips, min_trips=1)
    wrong = routes.where(F.col("trip_count_weekend") + F.col("trip_count_weekday") != F.col("trip_count"))
    assert wrong.count() == 0


def test_trend_counts_rows_not_days(raw):
    cleaned = clean.clean_trips(raw(at(1, 8) + at(3, 8, 3)))
    assert rows(temporal.daily_trend(cleaned)) == [("2015-01-01", 1, 1.0), ("2015-01-03", 3, 2.0)]
    assert rows(temporal.daily_trend(cleaned, days=1)) == [("2015-01-01", 1, 1.0)]


def test_time_range_includes_both_ends(raw):
    cleaned = clean.clean_trips(raw(at(1, 8) + at(2, 8) + at(3, 8)))
    daily = temporal.daily_counts(cleaned, start="2015-01-02 08:00:00", end="2015-01-03 08:00:00")
    assert daily.count() == 2


def test_parts_of_decomposition_add_up(small_trips):
    parts = temporal.decomposition(small_trips)
    off = parts.where(F.abs(F.col("trip_count") - F.col("trend") - F.col("seasonal") - F.col("residual")) > 1e-9)
    assert off.count() == 0


def test_hourly_slot_filters(small_trips):
    hourly = T.temporal_hourly_stats(small_trips)
    some = temporal.hourly_slots(hourly, year=1997, month=2, day_of_week=[2, 3], hour=4)
    expected = hourly.where("pickup_year = 1997 AND pickup_month = 2 AND pickup_day_of_week IN (2, 3) AND pickup_hour = 4")
    assert sorted(rows(some)) == sorted(rows(expected))
