"""Pages from counts per value range, rows cut before a top-n, and merged sketches."""

from datetime import datetime, timedelta

import pytest
from conftest import rows, trip
from pyspark.sql import functions as F

from curbline.operators import clean, explore, ranks, sketches
from curbline.plans import pages, state
from curbline.plans.store import TripStore
from curbline.sources import trips as source

MONTH = ["year", "month"]


@pytest.fixture(scope="module")
def odd_trips(raw):
    """NULL, NaN, infinities, ties, and values of all sizes."""
    nan, inf = float("nan"), float("inf")
    tips = [None, nan, inf, -inf, 0.0, -0.0, 1e300, -1e300, 5e-324, 1.0, 1.0, 9.999999999999998, 10.0, 1000.0, -3.25]
    made = [
        trip(
            tip_amount=tips[i % 15],
            passenger_count=None if i % 7 == 0 else i % 5,
            tpep_pickup_datetime=None if i % 11 == 0 else datetime(1969, 12, 31, 20) + timedelta(seconds=(i * 7919) % 9777),
            fare_amount=5.0 + i,
        )
        for i in range(90)
    ]
    timed = clean.with_duration(raw(made))
    return timed.withColumns({"year": F.year("tpep_pickup_datetime"), "month": F.col("VendorID") + F.col("payment_type")}).cache()


@pytest.mark.parametrize("direction", ["asc", "desc"])
@pytest.mark.parametrize("name", ["tip_amount", "passenger_count", "tpep_pickup_datetime", "fare_amount"])
def test_spans_hold_the_page(odd_trips, name, direction):
    counted = ranks.counts(odd_trips, MONTH).cache()
    whole = list(map(str, explore.explore(odd_trips, 1, 90, name, direction).collect()))
    for offset, size in ((0, 7), (3, 1), (30, 25), (85, 20)):
        found = ranks.span(counted, MONTH, name, direction, offset, size)
        part = odd_trips.where(ranks.within(found, name))
        page = explore.rows_from(part, offset - found["before"], size, name, direction, 2).collect()
        assert list(map(str, page)) == whole[offset : offset + size]
    assert ranks.span(counted, MONTH, name, direction, 90, 5) is None


def test_ranges_keep_the_order(spark):
    values = [-float("inf"), -1e308, -1000.0, -999.5, -1.0, -5e-324, -0.0, 0.0, 5e-324, 1e-300, 0.1, 0.3, 9.99, 9.999999999999998]
    values += [10.0, 10.05, 999.9999999999999, 1000.0, 2.0**53, 1e308, float("inf"), float("nan")]
    made = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    places = [r.p for r in made.select("i", ranks._number_range(F.col("v")).alias("p")).orderBy("i").collect()]
    assert places == sorted(places) and places[6] == places[7] and places[13] < places[14] < places[17]


def test_counts_of_parts_add_up(small_trips):
    whole = ranks.counts(small_trips, MONTH)
    parts = [ranks.counts(small_trips.where(F.col("VendorID") == v), MONTH) for v in (1, 2)]
    key = [*MONTH, "column", "range"]
    merged = parts[0].union(parts[1]).groupBy(*key).agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("last").alias("last"))
    assert sorted(map(str, rows(merged))) == sorted(map(str, rows(whole.select(*key, "n", "low", "last"))))


def test_pages_of_a_store(spark, small_trips, tmp_path):
    store = TripStore(str(tmp_path / "store"))
    some = small_trips.where("pickup_year = 1997 AND pickup_month <= 3").withColumn("load_id", F.lit("a"))
    some = some.withColumns({"year": F.col("pickup_year"), "month": F.col("pickup_month")})
    source.write_partitioned(some, store.cleaned_path, source.LOAD_PARTITIONS)
    source.write_partitioned(state.rank_state(some), store.state_path("ranks"), state.MONTH)
    cleaned, n = store.cleaned(spark), some.count()
    for name, nth, size, month in ((None, 2, 10, None), ("fare_amount", 3, 9, 2), ("pickup_longitude", 1, 5, None), ("none", 1, 8, 3)):
        wanted = {"year": 1997, "month": month}
        found = pages.page(spark, store, nth, size, name, "DESC", **wanted)
        assert found.collect() == explore.explore(cleaned, nth, size, name, "desc", **wanted).collect()
        assert rows(pages.page_info(spark, store, nth, size, **wanted)) == rows(explore.page_info(cleaned, nth, size, **wanted))
    past = pages.page(spark, store, n // 10 + 2, 10)
    assert past.columns == explore.PAGE_COLUMNS and past.count() == 0
    assert pages.page(spark, store, year=1901).count() == 0
    assert pages.page_info(spark, store, year=1901).first()["total_count"] == 0
    with pytest.raises(ValueError):
        pages.page(spark, store, 0)
    with pytest.raises(ValueError):
        pages.page(spark, store, order_direction="up")


def test_few_rows_are_ordered_before_a_top_n(spark, small_trips):
    made = spark.range(50_000).select("id", F.md5(F.col("id").cast("string")).alias("h"))
    bits = F.length(F.conv(F.substring("h", 1, 15), 16, 2))
    cut = explore._least_groups(made, bits, 1000)
    assert 1000 <= cut.count() <= 3000
    assert rows(cut.orderBy("h").limit(1000)) == rows(made.orderBy("h").limit(1000))
    assert explore._least_groups(made, bits, 60_000).count() == 50_000
    assert explore._least_groups(made.limit(0), bits, 5).count() == 0
    # one key of a third of all rows
    heavy = made.withColumn("key", F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")))
    digest = F.md5(F.col("key").cast("string"))
    want = [(float(r.id), float(r.key)) for r in heavy.orderBy(digest, "id", "key").limit(20_000).collect()]
    assert rows(explore.scatter(heavy, "id", "key", ["key"], 20_000)) == want
    assert explore.scatter(heavy.limit(0), "id", "key", ["key"]).count() == 0


def test_first_rows_with_missing_times(odd_trips):
    for n in (1, 5, 20, 89, 200):
        names = explore._order(odd_trips, None, "asc")
        want = odd_trips.withColumns({"pickup_year": F.lit(1), "pickup_month": F.lit(1)}).select(*explore.PAGE_COLUMNS)
        assert list(map(str, explore.head_rows(odd_trips, n).collect())) == list(map(str, want.orderBy(*names).limit(n).collect()))


def test_sketches_merge_within_their_bound(spark, small_trips):
    shares = [0.0, 0.03, 0.5, 0.97, 1.0]
    merged = sketches.quantiles(sketches.sketched(small_trips, MONTH), shares)
    told = sketches.checked(small_trips, merged).collect()
    assert len(told) == 20 and all(r.within for r in told) and {r.n for r in told} == {small_trips.count()}
    # a sketch of everything against one of halves, and values that are off
    off = merged.withColumn("value", F.col("value") + 1e6)
    assert not any(r.within for r in sketches.checked(small_trips, off).collect() if r.share < 0.9)
    by_year = sketches.quantiles(sketches.sketched(small_trips, MONTH), [0.5], ["year"])
    assert by_year.count() == 4 * small_trips.select("year").distinct().count()


def test_sketches_of_nothing(spark, small_trips):
    nothing = sketches.quantiles(sketches.sketched(small_trips.limit(0), MONTH), [0.5])
    assert {(r.n, r.value) for r in nothing.collect()} <= {(0, None), (None, None)}
    bare = small_trips.limit(3).withColumns({"trip_distance": F.lit(None).cast("double"), "trip_duration_minutes": F.lit(float("nan"))})
    found = {r.measure: (r.n, r.value) for r in sketches.quantiles(sketches.sketched(bare, MONTH), [0.5]).collect()}
    assert found["minutes"] == found["fare_per_mile"] == (0, None) and found["tip_percent"][0] == 3
