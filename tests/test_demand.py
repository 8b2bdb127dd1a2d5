from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from curbline.operators import anomalies, demand, forecast
from curbline.plans import tables as T


def hourly_frame(spark, counts):
    """{(year, month, weekday, hour): trips}"""
    return spark.createDataFrame(
        [(*k, n) for k, n in counts.items()],
        "pickup_year int, pickup_month int, pickup_day_of_week int, pickup_hour int, trip_count long",
    )


def test_surge_rules(spark):
    counts = {(2015, 1, 2, h): 10 for h in range(10)}
    counts[(2015, 1, 2, 10)] = 40
    counts[(2015, 1, 3, 5)] = 99  # a lone hour has no deviation
    counts.update({(2015, 2, 4, h): 7 for h in range(4)})  # no spread at all
    out = demand.demand_surge(hourly_frame(spark, counts)).collect()
    assert [(r["pickup_day_of_week"], r["pickup_hour"]) for r in out] == [(2, 10)]
    values = [10] * 10 + [40]
    assert out[0]["z_score"] == pytest.approx((40 - np.mean(values)) / np.std(values, ddof=1))


def test_hot_zones_equal_the_full_join(small_trips):
    zones = T.geospatial_zone_stats(small_trips)
    surge = demand.demand_surge(T.temporal_hourly_stats(small_trips))
    hours = surge.select(*T.HOURLY_KEYS)
    full = (
        zones.join(hours, ["pickup_year", "pickup_month"])
        .orderBy(F.desc("trip_count"), *T.ZONE_KEYS, "pickup_day_of_week", "pickup_hour")
        .limit(25)
    )
    columns = sorted(full.columns)
    assert rows(demand.hot_zones(zones, surge, 25).select(columns)) == rows(full.select(columns))


def test_inefficient_routes_clip_short_distances(spark):
    keys = "pickup_lat_grid double, pickup_lon_grid double, dropoff_lat_grid double, dropoff_lon_grid double"
    frame = spark.createDataFrame(
        [(40.7, -73.9, 40.8, -73.9, 300, 10.0, 0.05), (40.7, -73.9, 40.9, -73.9, 300, 10.0, 2.0), (40.7, -73.9, 40.6, -73.9, 200, 90.0, 1.0)],
        keys + ", trip_count long, avg_duration double, avg_distance double",
    )
    assert [r["minutes_per_mile"] for r in demand.inefficient_routes(frame).collect()] == [100.0, 5.0]


def test_robust_scores_against_numpy(spark):
    rng = np.random.default_rng(3)
    a, b = rng.normal(50, 5, 501), rng.gamma(2, 3, 501)
    a[7], b[11] = 500.0, 90.0
    frame = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(zip(a, b))], "i int, a double, b double")

    def score(x):
        m = np.sort(x)[len(x) // 2]
        return np.abs(x - m) / (1.4826 * np.sort(np.abs(x - m))[len(x) // 2])

    expected = np.maximum(score(a), score(b))
    got = {r["i"]: r["score"] for r in anomalies.robust_scores(frame, ["a", "b"]).collect()}
    assert [got[i] for i in range(501)] == pytest.approx(list(expected))
    flagged = {r["i"] for r in anomalies.robust_anomalies(frame, ["a", "b"], 0.01).collect()}
    assert flagged == set(np.argsort(-expected)[:6]) and {7, 11} <= flagged


def test_robust_scores_without_spread(spark):
    frame = spark.createDataFrame([(5.0,)] * 9 + [(6.0,)], "a double")
    scores = sorted(r["score"] for r in anomalies.robust_scores(frame, ["a"]).collect())
    assert scores[:9] == [0.0] * 9 and scores[9] > 1
    assert anomalies.robust_scores(spark.createDataFrame([(5.0,)] * 3, "a double"), ["a"]).agg(F.max("score")).first()[0] == 0.0


def test_forest_finds_planted_outliers_and_repeats_itself(spark):
    rng = np.random.default_rng(5)
    points = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.normal(0, 1, (1000, 2)))]
    points += [(1000, 12.0, 12.0), (1001, -11.0, 9.0), (1002, 0.0, -14.0)]
    frame = spark.createDataFrame(points, "i int, a double, b double")
    out = anomalies.isolation_forest(frame, ["a", "b"], ["i"], share=0.01)
    found = {r["i"]: r["score"] for r in out.collect()}
    assert {1000, 1001, 1002} <= set(found) and 8 <= len(found) <= 14
    assert max(found, key=found.get) >= 1000
    again = anomalies.isolation_forest(frame.repartition(6), ["a", "b"], ["i"], share=0.01)
    assert {r["i"]: r["score"] for r in again.collect()} == pytest.approx(found)


def test_forest_on_nothing_and_on_constants(spark):
    frame = spark.createDataFrame([(1, 2.0)] * 5, "i int, a double")
    assert anomalies.isolation_forest(frame.limit(0), ["a"], ["i"]).count() == 0
    assert anomalies.isolation_forest(frame, ["a"], ["i"]).count() == 5  # all alike: all at the cut


START = datetime(2015, 1, 1)


def series(spark, weeks=6, zones=("a", "b")):
    data = []
    for z, zone in enumerate(zones):
        for h in range(weeks * 168):
            n = 10 * (z + 1) + (h % 24) + 5 * ((h // 24) % 7 == 5)
            if h % 24 != 3:  # a quiet hour leaves no row
                data.append((zone, START + timedelta(hours=h), n))
    return spark.createDataFrame(data, "zone string, hour_start timestamp, trip_count long")


def test_lags_are_chronological_and_gap_free(spark):
    out = forecast.with_lags(series(spark), ["zone"])
    assert out.where("hour_ahead > 0").count() == 2 * 24
    assert out.where("hour_ahead > 0 AND trip_count IS NOT NULL").count() == 0
    row = out.where((F.col("zone") == "b") & (F.col("hour_start") == START + timedelta(hours=400))).first()
    known = {(r["zone"], r["hour_start"]): r["trip_count"] for r in series(spark).collect()}
    for lag in forecast.LAGS:
        assert row[f"lag_{lag}"] == known.get(("b", START + timedelta(hours=400 - lag)), 0)
    quiet = out.where("hour(hour_start) = 3 AND hour_ahead <= 0").agg(F.max("trip_count")).first()[0]
    assert quiet == 0.0


def test_forecast_of_a_periodic_series(spark):
    out = forecast.demand_forecast(series(spark), ["zone"]).collect()
    assert [(r["zone"], r["hour_ahead"]) for r in out] == [(z, h) for z in "ab" for h in range(1, 25)]
    for r in out:
        assert r["predicted_trips"] == pytest.approx(r["naive_trips"], abs=1.5)
    with pytest.raises(ValueError):
        forecast.demand_forecast(series(spark), ["zone"], horizon=25)


def test_history_limit_gives_the_same_future(spark):
    long = forecast.with_lags(series(spark), ["zone"]).where("hour_ahead > 0")
    short = forecast.with_lags(series(spark), ["zone"], history=forecast.WEEK).where("hour_ahead > 0")
    assert sorted(rows(long), key=str) == sorted(rows(short), key=str)


def test_naive_forecast_repeats_last_week(spark):
    s = series(spark)
    out = forecast.seasonal_naive_forecast(s, ["zone"]).collect()
    known = {(r["zone"], r["hour_start"]): r["trip_count"] for r in s.collect()}
    assert len(out) == 48
    for r in out:
        assert r["predicted_trips"] == known.get((r["zone"], r["hour_start"] - timedelta(hours=168)), 0)


def test_recent_demand_fills_gaps(spark):
    out = forecast.recent_demand(series(spark), ["zone"])
    assert out.count() == 2 * 168 and out.where("trip_count = 0").count() == 2 * 7


def test_backtest_beats_naive_on_a_noisy_series(spark):
    rng = np.random.default_rng(1)
    data = [
        (START + timedelta(hours=h), int(max(0, 50 + 20 * np.sin(2 * np.pi * h / 24) + rng.normal(0, 6))))
        for h in range(10 * 168)
    ]
    frame = spark.createDataFrame(data, "hour_start timestamp, trip_count long")
    r = forecast.backtest(frame).first()
    assert r["test_hours"] == 168 and r["model_mae"] < r["naive_mae"]


def test_a_stray_date_does_not_move_a_bounded_forecast(spark):
    from datetime import datetime, timedelta

    first = datetime(2015, 1, 1)
    hours = [(first + timedelta(hours=h), 100 + 10 * (h % 24)) for h in range(28 * 24)]
    steady = spark.createDataFrame(hours, "hour_start timestamp, trip_count long")
    stray = steady.union(spark.createDataFrame([(datetime(2084, 5, 1), 1)], steady.schema))
    bounds = {"start": "2015-01-01", "end": "2015-01-29"}
    for ask in (forecast.demand_forecast, forecast.seasonal_naive_forecast, forecast.recent_demand):
        for a, b in zip(sorted(rows(ask(stray, **bounds))), sorted(rows(ask(steady))), strict=True):
            assert [v for v in a if isinstance(v, (int, float))] == pytest.approx([v for v in b if isinstance(v, (int, float))], abs=1e-6)
            assert [v for v in a if isinstance(v, datetime)] == [v for v in b if isinstance(v, datetime)]
    assert forecast.with_lags(stray, **bounds).count() == forecast.with_lags(steady).count() == 28 * 24 - 168 + 24
