"""The whole batch: CSV drops to cleaned trips, tables, result sets and models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from curbline.operators import anomalies, clusters, demand, economic, forecast, geo, models, moments, temporal
from curbline.operators.sampling import SEED, bernoulli
from curbline.plans import incremental, state
from curbline.plans import tables as T
from curbline.plans.store import TripStore
from curbline.session import settled
from curbline.sources import storage
from curbline.sources import trips as source

STAGES = ("temporal", "geospatial", "economic", "ml")


def temporal_results(trips: DataFrame, hourly: DataFrame | None = None) -> dict[str, DataFrame]:
    """Counts and trends come from the hourly table when there is one."""
    grouped = trips if hourly is None else hourly
    return {
        "trips_by_hour": temporal.trips_by_hour(grouped),
        "trips_by_day": temporal.trips_by_day(grouped),
        "trips_by_month": temporal.trips_by_month(grouped),
        "peak_hours": temporal.peak_hours(grouped),
        "duration_distribution": temporal.duration_distribution(trips),
        "fare_trends_by_hour": temporal.fare_trends(grouped, "hour"),
        "fare_trends_by_month": temporal.fare_trends(grouped, "month"),
    }


def geospatial_results(
    trips: DataFrame, zones: DataFrame | None = None, routes: DataFrame | None = None, min_trips: int = 100
) -> dict[str, DataFrame]:
    cells = trips if zones is None else zones
    return {
        "pickup_hotspots": geo.pickup_hotspots(cells, min_trips=min_trips),
        "dropoff_hotspots": geo.dropoff_hotspots(cells, min_trips=min_trips),
        "route_pairs": geo.route_pairs(trips if routes is None else routes),
        "airport_compare": geo.airport_compare(trips),
    }


def economic_results(
    trips: DataFrame, fares: DataFrame | None = None, sums: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Tips and revenue come from the fare state, correlations and shares from the moment
    state, when there is one."""
    if fares is None:
        tips, revenue = (lambda key: economic.tip_analysis(trips, key)), economic.revenue_analysis(trips, "hour")
    else:
        tips, revenue = (lambda key: state.tip_analysis(fares, key)), state.revenue_by_hour(fares)
    return {
        "correlations": economic.correlations(trips) if sums is None else moments.correlations(sums),
        "tip_by_payment_type": tips("payment_type"),
        "tip_by_hour": tips("hour"),
        "tip_by_distance": tips("distance_bucket"),
        "revenue_by_hour": revenue,
        "market_share": economic.market_share(trips) if sums is None else moments.market_share(sums),
    }


def advanced_results(
    tables: dict[str, DataFrame],
    trips: DataFrame,
    segment_rows: DataFrame | None = None,
    route_min_trips: int = 200,
) -> dict[str, DataFrame]:
    """The six further analyses, by name, from the aggregate tables.

    Only the hourly series is taken from trips (and the customer segments, unless
    ``segment_rows`` brings them).
    """
    hourly, routes = tables["temporal_hourly_stats"], tables["route_pairs_top"]
    surge = demand.demand_surge(hourly)
    series = settled(forecast.hourly_demand(trips), "demand")
    segment_rows = clusters.segment_inputs(trips) if segment_rows is None else segment_rows
    return {
        "demand_forecast": forecast.demand_forecast(series),
        "demand_history": forecast.recent_demand(series),
        "route_optimization": demand.inefficient_routes(routes, above=route_min_trips),
        "surge_hours": surge,
        "surge_zones": demand.hot_zones(tables["geospatial_zone_stats"], surge),
        "customer_segments": clusters.customer_segments(settled(segment_rows, "segments")),
        "revenue_optimization": demand.revenue_windows(tables["economic_fare_analysis"]),
        "demand_anomalies": anomalies.demand_anomalies(hourly),
        "route_anomalies": anomalies.route_anomalies(routes),
    }


def run_advanced(spark: SparkSession, store: TripStore, route_min_trips: int = 200) -> dict[str, DataFrame]:
    """The further analyses of a store, also written as JSON under ``root/results``.

    Routes of ``route_min_trips`` trips are among those looked at, however small that is.
    """
    segments = state.segment_inputs(store.state(spark, "fares"), store.state(spark, "tips"))
    tables = store.tables(spark, min(T.MIN_ROUTE_TRIPS, route_min_trips))
    results = advanced_results(tables, store.cleaned(spark), segments, route_min_trips)
    source.write_results(results, f"{store.root.rstrip('/')}/results")
    return results


def run_batch(
    spark: SparkSession,
    input_dir: str,
    root: str,
    stages=STAGES,
    skip_ingestion: bool = False,
    skip_cleaning: bool = False,
    rebuild: bool = False,
    repair: bool = False,
    sample_fraction: float | None = None,
    hotspot_min_trips: int = 100,
    **model_params,
) -> dict[str, DataFrame]:
    """Ingest, clean, build state, analyse and train; returns the result sets.

    Result sets are also written as JSON under ``root/results`` and models under
    ``root/models``. A skipped step uses what an earlier run stored. On the full
    data counts, trends, hotspots and routes are rolled up from the stored state;
    with ``sample_fraction`` everything is computed from the sample.

    The folder's files are added to the store as loads of their own: what other loads
    brought stays, and only the months touched are refreshed. ``rebuild`` replaces
    everything by what the folder holds. ``repair`` reads badly typed cells in other ways
    before they count as missing.
    """
    unknown = set(stages) - set(STAGES)
    if unknown:
        raise ValueError(f"unknown stages {sorted(unknown)}")
    root = root.rstrip("/")
    store, raw_path = TripStore(root), f"{root}/raw"
    if not (skip_ingestion and storage.exists(spark, raw_path)):
        source.ingest_folder(spark, input_dir, raw_path, repair=repair)
    if not (skip_cleaning and storage.exists(spark, store.cleaned_path)):
        raw = spark.read.parquet(raw_path)
        if rebuild:
            source.write_cleaned(raw, store.cleaned_path)
            incremental.rebuild_all(spark, store)
        else:
            incremental.apply_load(spark, store, raw)

    trips, tables = store.cleaned(spark), {}
    if sample_fraction is not None and sample_fraction < 1.0:
        trips = bernoulli(trips, sample_fraction, SEED)
    else:
        tables = {"hourly": store.state(spark, "hourly"), "zones": store.state(spark, "zones")}
        tables["routes"], tables["fares"] = store.state(spark, "routes"), store.state(spark, "fares")
        tables["moments"] = store.state(spark, "moments")

    results: dict[str, DataFrame] = {}
    if "temporal" in stages:
        results.update(temporal_results(trips, tables.get("hourly")))
    if "geospatial" in stages:
        results.update(
            geospatial_results(trips, tables.get("zones"), tables.get("routes"), hotspot_min_trips)
        )
    if "economic" in stages:
        results.update(economic_results(trips, tables.get("fares"), tables.get("moments")))
    if "ml" in stages:
        trained = models.train_all(trips, **model_params)
        for model in trained.values():
            if model.model is not None:
                models.save(model, f"{root}/models")
        results["fare_models"] = models.metrics_frame(spark, trained)
    source.write_results(results, f"{root}/results")
    return results
