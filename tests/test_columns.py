import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows, trip
from curbline import schema as S
from curbline.functions import airports
from curbline.functions import columns as C
from curbline.operators import clean


def values(spark, data, expression, kind="double"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, v {kind}")
    return [r[0] for r in frame.orderBy("i").select(expression).collect()]


@pytest.mark.parametrize(
    "scheme,data,expected",
    [
        (S.DISTANCE_5WAY, [0.99, 1, 2.99, 3, 5, 9.99, 10], ["0-1mi", "1-3mi", "1-3mi", "3-5mi", "5-10mi", "5-10mi", "10+mi"]),
        (S.DISTANCE_3WAY, [1.99, 2, 4.99, 5], ["short", "medium", "medium", "long"]),
        (S.DISTANCE_4WAY, [1.9, 2, 5, 10], ["Short (<2 mi)", "Medium (2-5 mi)", "Long (5-10 mi)", "Very Long (>10 mi)"]),
        (S.DURATION_4WAY, [9.9, 10, 20, 40], ["0-10min", "10-20min", "20-40min", "40+min"]),
    ],
)
def test_bucket_edges(spark, scheme, data, expected):
    assert values(spark, [float(d) for d in data], C.bucket("v", *scheme)) == expected


@pytest.mark.parametrize("scheme", [S.DISTANCE_5WAY, S.DISTANCE_4WAY, S.DISTANCE_3WAY, S.DISTANCE_3WAY_TITLES])
def test_bands_refine_every_scheme(spark, scheme):
    data = [0.5, 0.99, 1, 1.5, 2, 2.5, 3, 4.9, 5, 7, 9.99, 10, 50]
    frame = spark.createDataFrame([(float(d),) for d in data], "v double").withColumn("band", C.distance_band("v"))
    wrong = frame.where(C.band_bucket("band", scheme) != C.bucket("v", *scheme))
    assert wrong.count() == 0


def test_hour_buckets(spark):
    hours = [0, 5, 6, 11, 12, 17, 18, 22, 23]
    expected = ["night"] * 2 + ["morning"] * 2 + ["afternoon"] * 2 + ["evening"] * 2 + ["night"]
    assert values(spark, hours, C.hour_bucket("v"), "int") == expected


def test_grid_rounds_half_away_from_zero(spark):
    assert values(spark, [40.754, 40.7551, -73.9849, -73.9851], C.grid("v")) == [40.75, 40.76, -73.98, -73.99]


def test_variable_grid(spark):
    index = C.grid_index("v", 0.05)
    assert values(spark, [40.76, 40.78], index) == [815, 816]


def test_tip_percent_and_per_mile(spark):
    frame = spark.createDataFrame([(2.0, 10.0, 4.0), (1.0, 0.0, 0.0)], "t double, f double, d double")
    out = rows(frame.select(C.tip_percent("t", "f"), C.tip_percent("t", "f", guarded=False), C.per_mile("f", "d")))
    assert out == [(20.0, 20.0, 2.5), (0.0, None, None)]


def test_z_score_guard(spark):
    frame = spark.createDataFrame([(5.0, 3.0, 2.0), (5.0, 3.0, 0.0), (5.0, 3.0, None)], "x double, m double, s double")
    assert [r[0] for r in frame.select(C.z_score("x", "m", "s")).collect()] == [1.0, 0.0, 0.0]


def test_clip(spark):
    assert values(spark, [0.0, 0.1, 3.0, None], C.at_least("v", 0.1)) == [0.1, 0.1, 3.0, None]


def test_route_point_is_fixed_width(spark):
    frame = spark.createDataFrame([(40.7, -73.98)], "a double, o double")
    assert frame.select(C.route_point("a", "o")).first()[0] == "40.70,-73.98"


def test_months_spanned(spark):
    frame = spark.sql("SELECT timestamp'2015-11-03' a, timestamp'2016-02-01' b")
    assert frame.select(C.months_spanned("a", "b")).first()[0] == 4


@settings(max_examples=8, deadline=None)
@given(
    st.lists(
        st.tuples(*[st.floats(40.0, 41.0), st.floats(-75.0, -73.0)] * 2), min_size=1, max_size=5
    )
)
def test_haversine_against_plain_python(spark, points):
    frame = spark.createDataFrame([tuple(p) for p in points], "a double, b double, c double, d double")
    got = [r[0] for r in frame.select(C.haversine_miles("a", "b", "c", "d")).collect()]

    def plain(a, b, c, d):
        x1 = [math.cos(math.radians(a)) * math.cos(math.radians(b)), math.cos(math.radians(a)) * math.sin(math.radians(b)), math.sin(math.radians(a))]
        x2 = [math.cos(math.radians(c)) * math.cos(math.radians(d)), math.cos(math.radians(c)) * math.sin(math.radians(d)), math.sin(math.radians(c))]
        return 2 * 3959 * math.asin(min(1.0, math.dist(x1, x2) / 2))

    assert sorted(got) == pytest.approx(sorted(plain(*p) for p in points), abs=1e-4)


def test_airport_boxes(raw):
    jfk = S.AIRPORTS[0]
    edge = jfk["lat"] + jfk["radius_miles"] * S.DEGREES_PER_RADIUS_MILE
    data = [
        trip(pickup_latitude=jfk["lat"], pickup_longitude=jfk["lon"]),
        trip(pickup_latitude=edge, pickup_longitude=jfk["lon"]),
        trip(pickup_latitude=edge + 0.001, pickup_longitude=jfk["lon"]),
        trip(dropoff_latitude=40.7769, dropoff_longitude=-73.873),
        trip(pickup_latitude=40.6895, pickup_longitude=-74.1745, dropoff_latitude=40.7769, dropoff_longitude=-73.873),
    ]
    out = airports.airport_trips(clean.clean_trips(raw(data)))
    got = sorted(rows(out.select("airport_name", "direction")))
    assert got == [("EWR", "from_airport"), ("JFK", "from_airport"), ("JFK", "from_airport"), ("LGA", "to_airport")]


def test_exact_and_sketched_quantiles_agree(spark):
    frame = spark.range(1000).select((F.col("id") % 97).cast("double").alias("v"))
    exact = frame.agg(C.quantile("v", [0.25, 0.5, 0.95])).first()[0]
    assert exact == frame.agg(C.quantile("v", [0.25, 0.5, 0.95], accuracy=100_000)).first()[0]
    ordered = sorted(i % 97 for i in range(1000))
    assert exact == [ordered[249], ordered[499], ordered[949]]
