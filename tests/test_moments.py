"""Moments: merged, and against Spark ML and the operators that read trips."""

import pytest
from conftest import SF_SMALL, rows, trip
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from curbline.operators import economic, forecast, models, moments
from curbline.operators.clean import clean_trips
from curbline.plans import incremental, state
from curbline.plans.store import TripStore
from curbline.session import settled
from driver_tables.trips_view import raw_trips


@pytest.fixture(scope="module")
def stored(small_trips):
    return settled(state.moment_state(small_trips))


def test_the_line_is_that_of_spark_ml(spark, small_trips, stored):
    line, measured = moments.fare_line(stored)
    trained = models.train(small_trips, "linear_regression")
    own = trained.model.stages[-1]
    scaler = trained.model.stages[1]
    assert line.coefficients == pytest.approx([c / s for c, s in zip(own.coefficients, scaler.std, strict=True)], rel=1e-6, abs=1e-9)
    assert (measured.rmse, measured.r2) == pytest.approx((trained.rmse, trained.r2), rel=1e-6)
    assert (measured.training_rows, measured.test_rows) == (trained.training_rows, trained.test_rows)
    shares = {r["feature"]: r["importance"] for r in moments.fare_coefficients(spark, line).collect()}
    want = {r["feature"]: r["importance"] for r in models.feature_importance(spark, trained.model).collect()}
    assert shares.pop("intercept") is None and shares == pytest.approx(want, rel=1e-6, abs=1e-9)


def test_correlations_and_shares_are_those_of_trips(small_trips, stored):
    got = {(r["col_a"], r["col_b"]): r["corr"] for r in moments.correlations(stored).collect()}
    assert got == pytest.approx({(r["col_a"], r["col_b"]): r["corr"] for r in economic.correlations(small_trips).collect()}, abs=1e-9)
    got, want = rows(moments.market_share(stored)), rows(economic.market_share(small_trips))
    assert [r[:2] for r in got] == [r[:2] for r in want]
    assert [x for r in got for x in r[2:]] == pytest.approx([x for r in want for x in r[2:]])


def test_two_loads_are_one(spark, tmp_path):
    raw, lines = raw_trips(spark, SF_SMALL).where("month(tpep_pickup_datetime) < 4"), []
    for loads in ([F.lit("one")], [F.when(F.col("VendorID") == v, F.concat(F.lit("v"), F.col("VendorID"))) for v in (1, 2, 2)]):
        store = TripStore(f"{tmp_path}/{len(loads)}")
        for load in loads:
            incremental.apply_load(spark, store, raw.withColumn("load_id", load).where("load_id IS NOT NULL"))
        lines.append(moments.fare_line(store.state(spark, "moments")))
    (one, m1), (two, m2) = lines
    assert one.coefficients == pytest.approx(two.coefficients) and (m1.rmse, m1.r2, m1.test_rows) == pytest.approx((m2.rmse, m2.r2, m2.test_rows))


def test_nothing_and_one_trip(spark, raw):
    for trips in ([], [trip()], [trip(tip_amount=None)] * 3):
        own = state.moment_state(clean_trips(raw(trips)))
        line, measured = moments.fare_line(own)
        n = len(trips)
        assert measured.training_rows + measured.test_rows == n and moments.correlations(own).count() == 9
        assert (line is None) == (measured.training_rows == 0)
        if line is not None:  # nothing varies: the mean is all that is known
            assert line.intercept + moments.CENTRES.get(models.LABEL, 0) == 12.0 and not line.coefficients.any()
            assert {r["feature"]: r["coefficient"] for r in moments.fare_coefficients(spark, line).collect()}["intercept"] == 12.0


def test_the_forecast_is_that_of_spark_ml(spark):
    hours = spark.range(24 * 40).select((F.lit(1420070400) + F.col("id") * 3600).cast("timestamp").alias("hour_start"), (F.col("id") % 24 + F.pmod(F.hash("id"), F.lit(9))).alias("trip_count"))
    known = forecast.with_lags(settled(hours), horizon=0)
    line = forecast.fit(known)
    flags = [(F.hour("hour_start") == h).cast("double").alias(f"h{h}") for h in range(1, 24)]
    flags += [(F.dayofweek("hour_start") == d).cast("double").alias(f"d{d}") for d in range(2, 8)]
    wide = known.select("*", *flags)
    names = [f"lag_{n}" for n in forecast.LAGS] + [c for c in wide.columns if c[0] in "hd" and c[1:].isdigit()]
    model = LinearRegression(labelCol="trip_count", regParam=0.01).fit(VectorAssembler(inputCols=names, outputCol="features").transform(wide))
    assert line.coefficients == pytest.approx(list(model.coefficients), rel=1e-6, abs=1e-8)
    assert line.intercept == pytest.approx(model.intercept, rel=1e-6)
    with pytest.raises(ValueError, match="history"):
        forecast.fit(known.limit(0))
