"""Aggregate tables as per-month state that merges exactly.

Every state is partitioned by (year, month) and depends on that month's trips
only, so a month can be rebuilt alone and in any order. The final tables are
projections or roll-ups of the states:

* hourly, zone, route and airport tables have the month in their grain, so their
  rows (medians included) are final as stored; the route threshold is applied on
  read;
* fare and tip tables roll sums up over months, on bands fine enough for every
  distance bucket scheme;
* the tip median rolls up from counts per distinct tip;
* the summary merges counts, means and squared deviations;
* sums and products of the model's variables add up (``operators.moments``);
* rows per value range add up, and pages are found from them (``operators.ranks``);
* sketches of numbers without a grid merge (``operators.sketches``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curbline import schema as S
from curbline.functions import columns as C
from curbline.functions.rollup import percent_of
from curbline.operators import clusters, economic, moments, ranks, sketches
from curbline.plans import tables as T

MONTH = ["year", "month"]
FARE_STATE_KEYS = ["distance_band", "duration_bucket", "pickup_hour", "pickup_day_of_week", "payment_type"]
TIP_STATE_KEYS = ["payment_type", "pickup_hour", "distance_band", "passenger_count"]
SPREAD = {"fare": "fare_amount", "distance": "trip_distance", "duration": "trip_duration_minutes"}
PLAIN = {"tip": "tip_amount", "passengers": "passenger_count"}


def _by_month(table: DataFrame) -> DataFrame:
    return table.withColumns({"year": F.col("pickup_year"), "month": F.col("pickup_month")})


def hourly_state(trips: DataFrame) -> DataFrame:
    return _by_month(T.temporal_hourly_stats(trips))


def zone_state(trips: DataFrame) -> DataFrame:
    return _by_month(T.geospatial_zone_stats(trips))


def route_state(trips: DataFrame) -> DataFrame:
    return _by_month(T.route_pairs_top(trips, min_trips=1))


def airport_state(trips: DataFrame) -> DataFrame:
    return _by_month(T.airport_analysis(trips))


def fare_state(trips: DataFrame) -> DataFrame:
    """Sums behind the fare table, tip and revenue analysis and price elasticity."""
    keyed = trips.withColumns(
        {
            "distance_band": C.distance_band(),
            "duration_bucket": C.bucket("trip_duration_minutes", *S.DURATION_4WAY),
        }
    )
    rate = C.per_mile()
    return keyed.groupBy(*MONTH, *FARE_STATE_KEYS).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("fare_amount").alias("sum_fare"),
        F.sum("tip_amount").alias("sum_tip"),
        F.sum("total_amount").alias("sum_total"),
        F.sum("trip_distance").alias("sum_distance"),
        F.sum("trip_duration_minutes").alias("sum_duration"),
        F.sum(C.tip_percent()).alias("sum_tip_percent"),
        F.sum(rate).alias("sum_fare_per_mile"),
        F.count(rate).alias("n_per_mile"),
    )


def tip_state(trips: DataFrame) -> DataFrame:
    share = F.try_divide(F.col("tip_amount"), F.col("fare_amount"))
    return (
        trips.withColumn("distance_band", C.distance_band())
        .groupBy(*MONTH, *TIP_STATE_KEYS)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("tip_amount").alias("sum_tip"),
            F.sum("fare_amount").alias("sum_fare"),
            F.count_if(share > T.HIGH_TIP_SHARE).alias("high_tips"),
            F.count_if(F.col("tip_amount") == 0).alias("no_tips"),
        )
    )


def tip_values(trips: DataFrame) -> DataFrame:
    """How often each tip was given, per tip-table group."""
    return (
        trips.withColumn("distance_bucket", C.bucket("trip_distance", *S.DISTANCE_3WAY))
        .groupBy(*MONTH, *T.TIP_KEYS, "tip_amount")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def summary_state(trips: DataFrame) -> DataFrame:
    measures = []
    for name, column in {**SPREAD, **PLAIN}.items():
        measures += [
            F.count(column).alias(f"n_{name}"),
            F.avg(column).alias(f"mean_{name}"),
            F.min(column).alias(f"min_{name}"),
            F.max(column).alias(f"max_{name}"),
        ]
    for name, column in SPREAD.items():
        measures.append((F.var_pop(column) * F.count(column)).alias(f"dev_{name}"))
    return trips.groupBy(*MONTH).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(C.PICKUP).alias("min_date"),
        F.max(C.PICKUP).alias("max_date"),
        F.sum("fare_amount").alias("sum_fare"),
        *measures,
    )


def moment_state(trips: DataFrame) -> DataFrame:
    """Sums and products behind correlations, market shares and the linear fare model."""
    return moments.moments(trips, MONTH)


def rank_state(trips: DataFrame) -> DataFrame:
    """Rows per month and value range of the displayed columns."""
    return ranks.counts(trips, MONTH)


def sketch_state(trips: DataFrame) -> DataFrame:
    """Sketches of the ratios and durations of a month."""
    return sketches.sketched(trips, MONTH)


STATES = {
    "hourly": hourly_state,
    "zones": zone_state,
    "routes": route_state,
    "airports": airport_state,
    "fares": fare_state,
    "tips": tip_state,
    "tip_values": tip_values,
    "summary": summary_state,
    "moments": moment_state,
    "ranks": rank_state,
    "sketches": sketch_state,
}


# ---- states -> final tables -----------------------------------------------------


def routes_from_state(routes: DataFrame, min_trips: int = T.MIN_ROUTE_TRIPS) -> DataFrame:
    return routes.drop(*MONTH).where(F.col("trip_count") >= min_trips)


def fares_from_state(fares: DataFrame) -> DataFrame:
    rolled = fares.groupBy(
        C.band_bucket("distance_band", S.DISTANCE_5WAY).alias("distance_bucket"), *T.FARE_KEYS[1:]
    ).agg(*[F.sum(c).alias(c) for c in ("n", "sum_fare", "sum_tip", "sum_distance", "sum_duration")])
    return rolled.select(
        *T.FARE_KEYS,
        F.col("n").alias("trip_count"),
        (F.col("sum_fare") / F.col("n")).alias("avg_fare"),
        (F.col("sum_tip") / F.col("n")).alias("avg_tip"),
        percent_of(F.col("sum_tip"), F.col("sum_fare")).alias("tip_percentage"),
        F.col("sum_fare").alias("total_revenue"),
        F.try_divide("sum_fare", "sum_distance").alias("fare_per_mile"),
        F.try_divide("sum_fare", "sum_duration").alias("fare_per_minute"),
    )


def weighted_quantile(counts: DataFrame, keys: list[str], value: str, n: str, p: float, name: str) -> DataFrame:
    """Smallest value with at least a share ``p`` of the counted rows at or below it."""
    group = Window.partitionBy(*keys)
    upto = group.orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    placed = counts.where(F.col(value).isNotNull()).withColumns(
        {"_upto": F.sum(n).over(upto), "_all": F.sum(n).over(group)}
    )
    reached = F.when(F.col("_upto") >= F.lit(p) * F.col("_all"), F.col(value))
    return placed.groupBy(*keys).agg(F.min(reached).alias(name))


def _rolled_tips(tips: DataFrame, keys, scheme) -> DataFrame:
    """Tip rates on some of the tip keys and any distance scheme."""
    bucket = C.band_bucket("distance_band", scheme).alias("distance_bucket")
    sums = tips.groupBy(*[bucket if k == "distance_bucket" else F.col(k) for k in keys]).agg(
        *[F.sum(c).alias(c) for c in ("n", "sum_tip", "sum_fare", "high_tips", "no_tips")]
    )
    n = F.col("n")
    return sums.select(
        *keys,
        n.alias("trip_count"),
        (F.col("sum_tip") / n).alias("avg_tip"),
        percent_of(F.col("sum_tip"), F.col("sum_fare")).alias("tip_percentage"),
        percent_of(F.col("high_tips"), n).alias("high_tipper_rate"),
        percent_of(F.col("no_tips"), n).alias("no_tip_rate"),
    )


def tips_from_state(tips: DataFrame, values: DataFrame) -> DataFrame:
    counts = values.groupBy(*T.TIP_KEYS, "tip_amount").agg(F.sum("n").alias("n"))
    medians = weighted_quantile(counts, T.TIP_KEYS, "tip_amount", "n", 0.5, "median_tip")
    # the same grouping key on both sides; null-safe, as groups are
    m = medians.toDF(*[f"m_{c}" for c in T.TIP_KEYS], "median_tip")
    same = [F.col(c).eqNullSafe(F.col(f"m_{c}")) for c in T.TIP_KEYS]
    joined = _rolled_tips(tips, T.TIP_KEYS, S.DISTANCE_3WAY).join(m, same, "left")
    return joined.drop(*[f"m_{c}" for c in T.TIP_KEYS])


def segment_inputs(fares: DataFrame, tips: DataFrame) -> DataFrame:
    """``clusters.segment_inputs`` without reading a trip."""
    rates = _rolled_tips(tips, clusters.SEGMENT_KEYS, S.DISTANCE_5WAY)
    return clusters.join_segments(fares_from_state(fares), rates)


def summary_from_state(months: DataFrame) -> DataFrame:
    """Merge per-month moments: one row per month goes through the window."""
    everything = Window.partitionBy()
    for name in SPREAD:
        n, mean = F.col(f"n_{name}"), F.col(f"mean_{name}")
        overall = F.try_divide(F.sum(n * mean).over(everything), F.sum(n).over(everything))
        months = months.withColumn(f"shift_{name}", F.coalesce(n * F.pow(mean - overall, 2), F.lit(0.0)))
    measures = []
    for name in {**SPREAD, **PLAIN}:
        n = F.col(f"n_{name}")
        measures += [
            F.try_divide(F.sum(n * F.col(f"mean_{name}")), F.sum(n)).alias(f"avg_{name}"),
            F.min(f"min_{name}").alias(f"min_{name}"),
            F.max(f"max_{name}").alias(f"max_{name}"),
        ]
    spreads = [
        F.sqrt(
            F.try_divide(F.sum(F.coalesce(f"dev_{name}", F.lit(0.0)) + F.col(f"shift_{name}")), F.sum(f"n_{name}") - 1)
        ).alias(f"stddev_{name}")
        for name in SPREAD
    ]
    row = months.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"),
        F.min("min_date").alias("min_date"),
        F.max("max_date").alias("max_date"),
        F.sum("sum_fare").alias("total_revenue"),
        *measures,
        *spreads,
    )
    return T.with_summary_ratios(row)


# name -> table, given a way to get a state by name and the route threshold
FINAL_TABLES = {
    "temporal_hourly_stats": lambda get, _: get("hourly").drop(*MONTH),
    "geospatial_zone_stats": lambda get, _: get("zones").drop(*MONTH),
    "route_pairs_top": lambda get, min_trips: routes_from_state(get("routes"), min_trips),
    "economic_fare_analysis": lambda get, _: fares_from_state(get("fares")),
    "tip_behavior_analysis": lambda get, _: tips_from_state(get("tips"), get("tip_values")),
    "airport_analysis": lambda get, _: get("airports").drop(*MONTH),
    "summary_stats": lambda get, _: summary_from_state(get("summary")),
}


# ---- economic questions answered from the fare state ----------------------------


def _fare_state_keys(group_by: str):
    if group_by == "distance_bucket":
        return [C.band_bucket("distance_band", S.DISTANCE_3WAY_TITLES).alias("distance_bucket")]
    if group_by == "location":
        raise ValueError("the fare state holds no locations; ask the trips")
    return economic.group_keys(group_by)


def tip_analysis(fares: DataFrame, group_by: str = "payment_type") -> DataFrame:
    """``economic.tip_analysis`` without reading a trip."""
    out = fares.groupBy(*_fare_state_keys(group_by)).agg(
        (F.sum("sum_tip_percent") / F.sum("n")).alias("avg_tip_percent"), F.sum("n").alias("trip_count")
    )
    return out.orderBy(out.columns[0])


def revenue_by_hour(fares: DataFrame, year=None) -> DataFrame:
    """``economic.revenue_analysis`` by hour without reading a trip."""
    if year is not None:
        fares = fares.where(F.col("year") == int(year))
    out = fares.groupBy(F.col("pickup_hour").alias("hour")).agg(
        (F.sum("sum_total") / F.sum("n")).alias("avg_revenue"), F.sum("n").alias("trip_count")
    )
    return out.orderBy("hour")


def price_elasticity(fares: DataFrame) -> DataFrame:
    """``economic.price_elasticity`` without reading a trip."""
    buckets = C.band_bucket("distance_band", S.DISTANCE_4WAY).alias("distance_bucket")
    return fares.groupBy(buckets).agg(
        F.try_divide(F.sum("sum_fare_per_mile"), F.sum("n_per_mile")).alias("avg_fare_per_mile"),
        (F.sum("sum_fare") / F.sum("n")).alias("avg_fare"),
        (F.sum("sum_distance") / F.sum("n")).alias("avg_distance"),
        F.sum("n").alias("trip_count"),
    )
