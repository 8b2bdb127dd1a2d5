import pytest
from pyspark.sql import functions as F

from conftest import rows, trip
from curbline.operators import clean, economic, explore, geo, sampling
from curbline.plans import tables as T


def page_rows(df):
    return [tuple(r[c] for c in explore.PAGE_COLUMNS) for r in df.collect()]


@pytest.mark.parametrize("order_by,direction", [(None, "asc"), ("fare_amount", "desc"), ("passenger_count", "asc")])
def test_pages_concatenate_to_the_ordered_set(small_trips, order_by, direction):
    wanted = dict(payment_type=1, min_fare=4.0, max_passengers=4)
    total = explore.page_info(small_trips, 1, 200, **wanted).first()
    pages = []
    for p in range(1, total["total_pages"] + 1):
        pages += page_rows(explore.explore(small_trips, p, 200, order_by, direction, **wanted))
    first = order_by or "tpep_pickup_datetime"
    names = [first] + [c for c in explore.PAGE_COLUMNS if c != first]
    everything = [
        r
        for r in small_trips.collect()
        if r["payment_type"] == 1 and r["fare_amount"] >= 4.0 and r["passenger_count"] <= 4
    ]
    everything.sort(key=lambda r: tuple(r[c] for c in names), reverse=direction == "desc")
    assert pages == [tuple(r[c] for c in explore.PAGE_COLUMNS) for r in everything]
    assert total["total_count"] == len(everything)


@pytest.mark.parametrize(
    "order_by,direction", [(None, "asc"), (None, "desc"), ("trip_distance", "desc"), ("passenger_count", "asc"), ("payment_type", "desc")]
)
@pytest.mark.parametrize("page", [1, 7, 23, 40, 900])
def test_deep_pages_equal_shallow_ones(small_trips, order_by, direction, page):
    deep = explore.explore(small_trips, page, 60, order_by, direction, rest_rows=5)
    assert page_rows(deep) == page_rows(explore.explore(small_trips, page, 60, order_by, direction))


@pytest.mark.parametrize("direction", ["asc", "desc"])
def test_deep_pages_with_missing_values(spark, small_trips, direction):
    holes = small_trips.withColumn("tip_amount", F.when(F.col("fare_amount") > 12, F.col("tip_amount")))
    for page in (1, 12, 25, 45):
        deep = explore.explore(holes, page, 50, "tip_amount", direction, rest_rows=3)
        assert page_rows(deep) == page_rows(explore.explore(holes, page, 50, "tip_amount", direction))


@pytest.mark.parametrize("direction", ["asc", "desc"])
def test_keyset_page_follows_the_last_row(small_trips, direction):
    first = explore.explore(small_trips, 1, 40, "fare_amount", direction).collect()
    following = explore.explore_after(small_trips, first[-1].asDict(), 40, "fare_amount", direction)
    assert page_rows(following) == page_rows(explore.explore(small_trips, 2, 40, "fare_amount", direction))


def test_page_bounds():
    with pytest.raises(ValueError):
        explore.explore(None, 1, 1001)
    with pytest.raises(ValueError):
        explore.explore(None, 0, 10)


def test_histogram_holds_every_row(small_trips):
    for bins in (1, 7, 20):
        out = explore.histogram(small_trips, "trip_distance", bins)
        assert out.agg(F.sum("count")).first()[0] == small_trips.count()
        assert out.agg(F.max("bin")).first()[0] == bins - 1


def test_histogram_labels_and_constant_column(raw):
    cleaned = clean.clean_trips(raw([trip(fare_amount=10.0), trip(fare_amount=20.0), trip(fare_amount=12.0)]))
    assert rows(explore.histogram(cleaned, "fare_amount", 2)) == [
        (0, 10.0, 15.0, 2, "10.0-15.0"),
        (1, 15.0, 20.0, 1, "15.0-20.0"),
    ]
    assert rows(explore.histogram(cleaned, "passenger_count", 5)) == [(0, 1.0, 2.0, 3, "1.0-2.0")]


def test_scatter_does_not_depend_on_partitioning(small_trips):
    keys = ["tpep_pickup_datetime", "fare_amount", "trip_distance"]
    few = explore.scatter(small_trips, "trip_distance", "fare_amount", keys, 50)
    many = explore.scatter(small_trips.repartition(7), "trip_distance", "fare_amount", keys, 50)
    assert rows(few) == rows(many)


def test_market_shares_add_up(small_trips):
    assert economic.market_share(small_trips).agg(F.sum("market_share_percent")).first()[0] == pytest.approx(100)


def test_surge_against_row_windows(small_trips):
    """Counting fares before the window gives what a window over trips gives."""
    from pyspark.sql import Window

    w = Window.partitionBy("pickup_hour", "pickup_lat_grid", "pickup_lon_grid")
    direct = (
        small_trips.withColumn("m", F.avg("fare_amount").over(w))
        .withColumn("s", F.stddev("fare_amount").over(w))
        .withColumn("z", F.when(F.col("s").isNull() | (F.col("s") == 0), 0.0).otherwise((F.col("fare_amount") - F.col("m")) / F.col("s")))
        .where(F.abs("z") > 1.5)
    )
    total = economic.fare_surge_totals(small_trips, threshold=1.5).first()
    assert total["total_surge_events"] == direct.count() > 0
    per_hour = {r["pickup_hour"]: r["count"] for r in direct.groupBy("pickup_hour").count().collect()}
    got = {r["hour"]: r["surge_count"] for r in economic.fare_surge_hours(small_trips, 1.5, 24).collect()}
    assert got == per_hour


def test_surge_sample_is_scaled_up(small_trips):
    full = economic.fare_surge_totals(small_trips, threshold=1.0).first()["total_surge_events"]
    half = economic.fare_surge_totals(small_trips, threshold=1.0, fraction=0.5).first()["total_surge_events"]
    assert half % 2 == 0 and half != full


def test_airport_without_trips_keeps_its_row(raw):
    cleaned = clean.clean_trips(raw([trip()]))
    assert rows(geo.airport_compare(cleaned)) == [("JFK", 0, None, None, None), ("LGA", 0, None, None, None)]


def test_route_top_over_months_differs_from_by_month(raw):
    from datetime import datetime, timedelta

    def on(month, **changes):
        start = datetime(2015, month, 2, 9)
        return trip(tpep_pickup_datetime=start, tpep_dropoff_datetime=start + timedelta(minutes=9), **changes)

    spread = [on(1), on(2), on(3)]
    packed = [on(4, pickup_latitude=40.7)] * 2
    cleaned = clean.clean_trips(raw(spread + packed))
    assert geo.route_pairs(cleaned, 1).first()["trip_count"] == 3
    assert geo.route_pairs(cleaned, 1, by_month=True).first()["trip_count"] == 2
    table = T.route_pairs_top(cleaned, min_trips=1)
    assert rows(geo.route_pairs(table)) == rows(geo.route_pairs(cleaned))


@pytest.mark.parametrize("direction", ["asc", "desc"])
@pytest.mark.parametrize("order_by", ["tip_amount", "store_and_fwd_flag", "passenger_count", "tpep_pickup_datetime"])
def test_pages_over_any_values(raw, order_by, direction):
    """NULL, NaN, infinities, ties and texts: pages concatenate to the sorted rows."""
    from datetime import datetime, timedelta

    nan, inf = float("nan"), float("inf")
    tips = [None, nan, inf, -inf, 0.0, -0.0, 1e300, -1e300, 5e-324, 1.0, 1.0, 1.0]
    flags = [None, "", "N", "Y", "Ya", "Yb", "é", "\U0001f600", "N", "N\x00"]
    rows_ = [
        trip(tip_amount=tips[i % 12], store_and_fwd_flag=flags[i % 10], passenger_count=None if i % 7 == 0 else i % 5,
             tpep_pickup_datetime=datetime(2015, 1, 1) + timedelta(seconds=(i * 7919) % 977), fare_amount=5.0 + i)
        for i in range(90)
    ]
    timed = clean.with_duration(raw(rows_))
    whole = explore.explore(timed, 1, 90, order_by, direction, rest_rows=1000).collect()
    for page, size in ((1, 7), (5, 7), (13, 7), (3, 40)):
        found = explore.explore(timed, page, size, order_by, direction, rest_rows=2).collect()
        assert list(map(str, found)) == list(map(str, whole[(page - 1) * size : page * size]))
    assert explore.explore(timed, 14, 7, order_by, direction, rest_rows=2).count() == 0


def test_no_step_counts_more_groups_than_bins(small_trips):
    for name in ("pickup_longitude", "tpep_pickup_datetime", "VendorID"):
        value, whole = next(iter(explore._positions(small_trips, name)))
        low, high = small_trips.agg(*explore._bounds(value, whole)).first()
        groups = small_trips.groupBy(explore._bin(value, whole, low, high)).count().count()
        assert groups <= explore.SEEK_BINS + 4


def test_bernoulli_is_a_repeatable_subset(spark):
    frame = spark.range(20_000)
    some = sampling.bernoulli(frame, 0.25, seed=3)
    assert some.count() == pytest.approx(5000, rel=0.1)
    assert some.exceptAll(sampling.bernoulli(frame, 0.25, seed=3)).count() == 0
    assert sampling.bernoulli(frame, 1.0).count() == 20_000
    assert sampling.bernoulli(frame, 0.0).count() == 0


def test_bernoulli_goes_by_value(spark):
    frame = spark.range(20_000).withColumn("odd.name", F.when(F.col("id") % 2 == 0, F.col("id")))
    for keys in (None, ["id"]):
        some = sampling.bernoulli(frame, 0.25, 3, keys)
        again = sampling.bernoulli(frame.repartition(7, "id"), 0.25, 3, keys)
        assert some.count() == pytest.approx(5000, rel=0.1)
        assert sorted(r["id"] for r in some.collect()) == sorted(r["id"] for r in again.collect())
        assert sampling.bernoulli(frame, 0.5, 3, keys).join(some, "id", "left_semi").count() == some.count()


def test_hash_split_is_disjoint_and_stable(spark):
    frame = spark.range(20_000)
    a, b = sampling.hash_split(frame, ["id"])
    assert a.count() + b.count() == 20_000
    assert a.join(b, "id").count() == 0
    assert a.count() == pytest.approx(16_000, rel=0.03)
    again, _ = sampling.hash_split(frame.repartition(5), ["id"])
    assert again.exceptAll(a).count() == 0
