"""Tips, revenue, prices, market share and the correlations between them."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbline import schema as S
from curbline.functions import columns as C
from curbline.functions import filters
from curbline.functions.airports import airport_label
from curbline.functions.rollup import percent_of

CORRELATED = ("fare_amount", "trip_distance", "trip_duration_minutes")


def group_keys(group_by: str) -> list[Column]:
    if group_by == "payment_type":
        return [F.col("payment_type")]
    if group_by == "hour":
        return [F.col("pickup_hour").alias("hour")]
    if group_by == "distance_bucket":
        return [C.bucket("trip_distance", *S.DISTANCE_3WAY_TITLES).alias("distance_bucket")]
    if group_by == "location":
        return [F.col("pickup_lat_grid").alias("latitude"), F.col("pickup_lon_grid").alias("longitude")]
    raise ValueError(f"cannot group by {group_by!r}")


def _with_keys(trips: DataFrame, group_by: str, *columns: Column) -> tuple[DataFrame, list[str]]:
    keys = group_keys(group_by)
    framed = trips.select(*keys, *columns)
    return framed, framed.columns[: len(keys)]


def tip_analysis(trips: DataFrame, group_by: str = "payment_type", guarded: bool = True) -> DataFrame:
    """Mean of per-trip tip percents, and trips, per group.

    Groups: ``payment_type``, ``hour``, ``distance_bucket`` or ``location``
    (pickup cell). Unguarded percents skip trips without a fare.
    """
    tips, keys = _with_keys(trips, group_by, C.tip_percent(guarded=guarded).alias("tip_percentage"))
    out = tips.groupBy(*keys).agg(
        F.avg("tip_percentage").alias("avg_tip_percent"), F.count(F.lit(1)).alias("trip_count")
    )
    return out.orderBy(*keys)


def tip_ratio(df: DataFrame, group_by: str = "payment_type") -> DataFrame:
    """All tips over all fares, in percent, per group: a fare-weighted mean.

    Takes trips, or the stored tip state with its ``sum_tip`` and ``sum_fare``.
    """
    stored = "sum_tip" in df.columns
    tip, fare, n = ("sum_tip", "sum_fare", F.sum("n")) if stored else ("tip_amount", "fare_amount", F.count(F.lit(1)))
    keys = group_keys(group_by)
    out = df.groupBy(*keys).agg(
        percent_of(F.sum(tip), F.sum(fare)).alias("tip_ratio_percent"), n.alias("trip_count")
    )
    return out.orderBy(*out.columns[: len(keys)])


def tip_group_mean(tip_table: DataFrame, group_by: str = "payment_type") -> DataFrame:
    """From the tip table: unweighted mean of the group ratios.

    Every stored group counts the same, however few trips it has. Kept beside
    the weighted forms for callers who compare with reports made that way.
    """
    keys = group_keys(group_by)
    out = tip_table.groupBy(*keys).agg(F.avg("tip_percentage").alias("avg_tip_percent"))
    return out.orderBy(*out.columns[: len(keys)])


def revenue_analysis(trips: DataFrame, group_by: str = "hour", year=None) -> DataFrame:
    """Mean total amount and trips per ``hour`` or ``location``."""
    scoped = filters.calendar(trips, year)
    totals, keys = _with_keys(scoped, group_by, F.col("total_amount"))
    out = totals.groupBy(*keys).agg(
        F.avg("total_amount").alias("avg_revenue"), F.count(F.lit(1)).alias("trip_count")
    )
    return out.orderBy(*keys)


def price_elasticity(trips: DataFrame) -> DataFrame:
    """Mean fare per mile, fare and distance per distance bucket."""
    priced = trips.where(F.col("trip_distance") > 0)
    return priced.groupBy(C.bucket("trip_distance", *S.DISTANCE_4WAY).alias("distance_bucket")).agg(
        F.avg(C.per_mile()).alias("avg_fare_per_mile"),
        F.avg("fare_amount").alias("avg_fare"),
        F.avg("trip_distance").alias("avg_distance"),
        F.count(F.lit(1)).alias("trip_count"),
    )


def market_share(trips: DataFrame) -> DataFrame:
    """Trips, share of all trips, mean fare and mean total per vendor."""
    vendors = trips.groupBy(F.col("VendorID").alias("vendor_id")).agg(
        F.count(F.lit(1)).alias("trip_count"),
        F.avg("fare_amount").alias("avg_fare"),
        F.avg("total_amount").alias("avg_total"),
    )
    share = percent_of(F.col("trip_count"), F.sum("trip_count").over(Window.partitionBy()))
    return vendors.withColumn("market_share_percent", share)


def economic_insights(trips: DataFrame) -> DataFrame:
    """One row of seven findings, from a single scan.

    Tip rates are all tips over all fares; the airport premium compares the mean
    fare of trips with an airport end to the mean fare of all trips.
    """
    fare, tip, pay = F.col("fare_amount"), F.col("tip_amount"), F.col("payment_type")
    at_airport = F.coalesce(airport_label("pickup"), airport_label("dropoff")).isNotNull()
    hours = trips.groupBy("pickup_hour").agg(
        F.count(fare).alias("n"),
        F.sum(fare).alias("fares"),
        F.sum(tip).alias("tips"),
        F.count(F.when(at_airport, fare)).alias("airport_n"),
        F.sum(F.when(at_airport, fare)).alias("airport_fares"),
        *[
            F.sum(F.when(pay == code, amount)).alias(f"{name}_{kind}")
            for name, code in (("card", S.CARD), ("cash", S.CASH))
            for kind, amount in (("tips", tip), ("fares", fare))
        ],
    )
    earlier = -F.col("pickup_hour")
    totals = hours.select(
        "*",
        F.struct(percent_of(F.col("tips"), F.col("fares")).alias("v"), earlier.alias("k")).alias("tip_rank"),
        F.struct(F.try_divide(F.col("fares"), F.col("n")).alias("v"), earlier.alias("k")).alias("fare_rank"),
    ).agg(
        F.max("tip_rank").alias("best_tip"),
        F.max("fare_rank").alias("best_fare"),
        F.try_divide(F.sum("fares"), F.sum("n")).alias("city_fare"),
        F.try_divide(F.sum("airport_fares"), F.sum("airport_n")).alias("airport_fare"),
        percent_of(F.sum("card_tips"), F.sum("card_fares")).alias("card_rate"),
        percent_of(F.sum("cash_tips"), F.sum("cash_fares")).alias("cash_rate"),
    )
    card, cash = F.coalesce("card_rate", F.lit(0.0)), F.coalesce("cash_rate", F.lit(0.0))
    premium = percent_of(F.col("airport_fare") - F.col("city_fare"), F.col("city_fare"))
    return totals.select(
        (-F.col("best_tip.k")).alias("highest_tip_hour"),
        F.col("best_tip.v").alias("highest_tip_percent"),
        (-F.col("best_fare.k")).alias("best_revenue_hour"),
        F.coalesce(premium, F.lit(0.0)).alias("airport_premium"),
        F.when(cash > 0, card - cash).otherwise(F.lit(0.0)).alias("credit_card_tip_premium"),
        card.alias("credit_tip_rate"),
        cash.alias("cash_tip_rate"),
    )


def correlations(trips: DataFrame, columns=CORRELATED) -> DataFrame:
    """Pearson correlation of every pair of columns, in long form, in one pass.

    Rows with a NULL in either column of a pair are left out of that pair.
    """
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    once = trips.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])

    def cell(a: str, b: str) -> Column:
        if a == b:
            return F.lit(1.0)
        return F.col(f"`{a}|{b}`" if (a, b) in pairs else f"`{b}|{a}`")

    cells = [
        F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), cell(a, b).alias("corr"))
        for a, b in product(columns, columns)
    ]
    return once.select(F.inline(F.array(*cells)))


def _scored_fares(trips: DataFrame, fraction: float | None, seed: int) -> DataFrame:
    """Every distinct fare per (zone, hour) with its z-score and trip count.

    A trip's score depends on its zone, hour and fare only, so trips are counted
    per fare first. The window then sees each fare once, and a zone holding a
    third of all trips costs no more than its distinct fares.
    """
    if fraction is not None:
        trips = trips.sample(fraction, seed)
    zone = ["pickup_hour", "pickup_lat_grid", "pickup_lon_grid"]
    fares = trips.groupBy(*zone, "fare_amount").agg(
        F.count(F.lit(1)).alias("trip_count"),
        F.min(C.PICKUP).alias("first_pickup"),
        F.max(C.PICKUP).alias("last_pickup"),
    )
    w = Window.partitionBy(*zone)
    n, x = F.col("trip_count"), F.col("fare_amount")
    return (
        fares.withColumn("zone_n", F.sum(F.when(x.isNotNull(), n)).over(w))
        .withColumn("zone_avg_fare", F.try_divide(F.sum(n * x).over(w), F.col("zone_n")))
        .withColumn("spread", F.sum(n * F.pow(x - F.col("zone_avg_fare"), 2)).over(w))
        .withColumn("zone_std_fare", F.sqrt(F.try_divide(F.col("spread"), F.col("zone_n") - 1)))
        .withColumn("z_score", C.z_score("fare_amount", "zone_avg_fare", "zone_std_fare"))
    )


def fare_surge_hours(
    trips: DataFrame, threshold: float = 3.0, top_n: int = 10, fraction: float | None = None, seed: int = 42
) -> DataFrame:
    """Hours of day with the most fares further than ``threshold`` deviations
    from the mean of their zone and hour."""
    n = F.col("trip_count")
    surged = _scored_fares(trips, fraction, seed).where(F.abs("z_score") > threshold)
    hours = surged.groupBy(F.col("pickup_hour").alias("hour")).agg(
        F.sum(n).alias("surge_count"),
        (F.sum(n * F.col("fare_amount")) / F.sum(n)).alias("avg_surge_fare"),
        (F.sum(n * F.col("z_score")) / F.sum(n)).alias("avg_z_score"),
    )
    return hours.orderBy(F.desc("surge_count"), "hour").limit(top_n)


def fare_surge_totals(
    trips: DataFrame, threshold: float = 3.0, fraction: float | None = None, seed: int = 42
) -> DataFrame:
    """One row: surge events (scaled up when sampled), their percent of trips, and
    the events per calendar month of the date range."""
    n = F.col("trip_count")
    totals = _scored_fares(trips, fraction, seed).agg(
        F.coalesce(F.sum(F.when(F.abs("z_score") > threshold, n)), F.lit(0)).alias("events"),
        F.sum(n).alias("trips"),
        C.months_spanned(F.min("first_pickup"), F.max("last_pickup")).alias("months"),
    )
    scaled = F.round(F.col("events") * F.lit(1.0 if fraction is None else 1.0 / fraction)).cast("long")
    return totals.select(
        scaled.alias("total_surge_events"),
        F.coalesce(percent_of(F.col("events"), F.col("trips")), F.lit(0.0)).alias("surge_percentage"),
        F.try_divide(scaled, F.col("months")).alias("events_per_month"),
        F.lit(float(threshold)).alias("threshold"),
    )
