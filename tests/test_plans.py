"""The shape of the physical plans: what is read, pruned, shuffled and avoided."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF_SMALL
from curbline.operators import economic, explore, geo, temporal
from curbline.plans import incremental, pages
from curbline.plans import tables as T
from curbline.plans.store import TripStore
from curbline.sources import trips as source
from driver_tables.trips_view import raw_trips


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    made = TripStore(str(tmp_path_factory.mktemp("plans") / "store"))
    raw = raw_trips(spark, SF_SMALL).withColumn("load_id", F.lit("all.csv"))
    source.write_cleaned(raw, made.cleaned_path)
    incremental.rebuild_all(spark, made)
    return made


def test_calendar_filters_prune_folders(spark, store):
    for df in (
        temporal.trips_by_hour(store.cleaned(spark), year=1997, month=6),
        economic.revenue_analysis(store.cleaned(spark), "hour", year=1997),
        explore.explore(store.cleaned(spark), 2, year=1997),
        temporal.trips_by_hour(store.state(spark, "hourly"), year=1997),
        temporal.hourly_slots(store.state(spark, "hourly"), year=1997, hour=3),
        geo.zone_query(store.state(spark, "zones"), 1997, 6),
    ):
        assert "(year#" in plan_of(df).split("PartitionFilters: [")[1].split("]")[0]


def test_scans_read_only_the_columns_in_use(spark, store):
    trips = store.cleaned(spark)
    assert "ReadSchema: struct<pickup_hour:int>" in plan_of(temporal.trips_by_hour(trips))
    assert "ReadSchema: struct<>" in plan_of(source.load_report(trips))
    assert "ReadSchema: struct<VendorID:int,fare_amount:double,total_amount:double>" in plan_of(
        economic.market_share(trips)
    )


def test_range_filters_reach_the_scan(spark, store):
    plan = plan_of(explore.page_info(store.cleaned(spark), payment_type=1, min_fare=5.0))
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    assert "EqualTo(payment_type,1)" in pushed and "GreaterThanOrEqual(fare_amount,5.0)" in pushed


def test_top_n_keeps_n_rows_per_task(spark, store):
    trips = store.cleaned(spark)
    for df in (geo.pickup_hotspots(trips), geo.route_pairs(trips), temporal.peak_hours(trips), explore.head_rows(trips)):
        plan = plan_of(df)
        assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_single_pass_aggregates(spark, store):
    trips = store.cleaned(spark)
    for df in (T.summary_stats(trips), economic.correlations(trips), economic.economic_insights(trips), geo.zone_comparison(trips), economic.fare_surge_totals(trips)):
        assert plan_of(df).count("FileScan") == 1


def test_pages_of_a_store_read_few_files(spark, store):
    everything = len(store.cleaned(spark).inputFiles())
    for direction, nth in (("asc", 1), ("asc", 12), ("desc", 20)):
        found = pages.page(spark, store, nth, 100, order_direction=direction)
        assert found.collect() == explore.explore(store.cleaned(spark), nth, 100, order_direction=direction).collect()
        assert 0 < len(found.inputFiles()) < everything / 10
    plan = plan_of(pages.page(spark, store, 12, 100, "trip_distance"))
    assert "GreaterThanOrEqual(trip_distance" in plan and "LessThanOrEqual(trip_distance" in plan
    assert all("/state/ranks/" in f for f in pages.page_info(spark, store, 2).inputFiles())


# these run loads or fits while the plan is built
EAGER = {"incremental_merge", "stream_merge", "stream_corrected", "csv_ingest_report", "anomalies_hourly_forest"} | {
    "repaired_load_hourly",
    "advanced_analyses",
    "stored_cleaning_report",
    "stored_pages",
    "stored_rows_per_month",
}


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - EAGER))
def test_no_cross_join_and_no_python_in_the_plan(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF_SMALL))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert unwanted not in plan


def test_further_analyses_of_a_store(spark, store):
    from curbline.plans import batch

    out = batch.run_advanced(spark, store, route_min_trips=1)
    for name in ("demand_forecast", "surge_hours", "surge_zones", "customer_segments", "revenue_optimization"):
        assert spark.read.json(f"{store.root}/results/{name}").count() == out[name].count() > 0
