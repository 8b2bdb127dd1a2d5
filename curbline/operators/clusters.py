"""k-means groupings of trips and of fare/tip segments."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline import schema as S
from curbline.operators.sampling import SEED, bernoulli, bottom_k, spread
from curbline.plans import tables as T

SEGMENT_KEYS = ["payment_type", "pickup_hour", "distance_bucket"]
SEGMENT_FEATURES = ["avg_fare", "avg_tip", "tip_percentage", "total_revenue", "high_tipper_rate", "no_tip_rate"]


MAX_ITERATIONS = 20
#: A value enters the hash that draws starts in units of this size.
HASH_UNIT = 1e-6
#: Rows drawn at most in the search for different starts, before all points are looked at.
MAX_DRAWN = 100_000


@dataclass(frozen=True)
class Clusters:
    """Centres of k-means, in units of ``scales`` about ``means``; ``settled`` tells whether
    another round would leave them as they are."""

    columns: tuple[str, ...]
    means: tuple[float, ...]
    scales: tuple[float, ...]
    centres: tuple[tuple[float, ...], ...]
    settled: bool

    def features(self) -> list[Column]:
        return [(F.col(c) - F.lit(m)) / F.lit(s) for c, m, s in zip(self.columns, self.means, self.scales, strict=True)]

    def assigned(self, df: DataFrame, label: str) -> DataFrame:
        """Rows with the number of the nearest centre; of equally near ones the first."""
        away = []
        for i, centre in enumerate(self.centres):
            parts = [(x - F.lit(v)) * (x - F.lit(v)) for x, v in zip(self.features(), centre, strict=True)]
            away.append(F.struct(reduce(Column.__add__, parts).alias("away"), F.lit(i).alias("nth")))
        return df.withColumn(label, F.array_min(F.array(*away))["nth"])


def _hashed(columns, seed: int) -> Column:
    """A hash of a row's values, which other engines compute alike."""
    parts = [F.round(F.col(c) / F.lit(HASH_UNIT)).cast("long").cast("string") for c in columns]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))


def _starts(rows: DataFrame, columns, k: int, seed: int, count: int) -> list[tuple[float, ...]]:
    """The k different points of smallest hash, or all, if there are fewer."""
    drawn, many = [], 4 * k
    while True:  # copies of a point share its hash, so a draw may hold few different ones
        taken = bottom_k(rows.select(*columns, _hashed(columns, seed).alias("hash")), F.col("hash"), many, count)
        drawn = list(dict.fromkeys(tuple(r[c] for c in columns) for r in taken.orderBy("hash", *columns).collect()))
        if len(drawn) >= k or many >= min(count, MAX_DRAWN):
            break
        many *= 8
    if len(drawn) < min(k, count):
        points = rows.select(*columns, _hashed(columns, seed).alias("hash")).distinct().orderBy("hash", *columns).limit(k)
        drawn = [tuple(r[c] for c in columns) for r in points.collect()]
    return drawn[:k]


def kmeans(rows: DataFrame, columns, k: int, scaled: bool, seed: int = SEED, iterations: int = MAX_ITERATIONS) -> Clusters:
    """Centres after ``iterations`` rounds of assignment and mean (or fewer, once they stay
    as they are), from starts chosen by a hash of their values. A cluster that loses all
    its rows keeps its centre.

    ``rows`` are read once a round: give them stored, without NULLs in ``columns``. Of
    each round the driver sees k centres.
    """
    columns = tuple(columns)
    about = rows.agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_samp(c).alias(f"s_{c}") for c in columns]).first()
    means = tuple(about[f"m_{c}"] if scaled else 0.0 for c in columns)
    scales = tuple((about[f"s_{c}"] or 1.0) if scaled else 1.0 for c in columns)
    starts = _starts(rows, columns, k, seed, about["n"]) if about["n"] else []
    centres = tuple(tuple((x - m) / s for x, m, s in zip(point, means, scales, strict=True)) for point in starts)
    found = Clusters(columns, means, scales, centres, False)
    for _ in range(iterations if centres else 0):
        new = found.assigned(rows, "nth").groupBy("nth").agg(*[F.avg(x).alias(f"c{i}") for i, x in enumerate(found.features())])
        moved = {r["nth"]: tuple(r[f"c{i}"] for i in range(len(columns))) for r in new.collect()}
        centres = tuple(moved.get(i, old) for i, old in enumerate(found.centres))
        if centres == found.centres:
            return replace(found, settled=True)
        found = replace(found, centres=centres)
    return found


def _complete(df: DataFrame, columns) -> DataFrame:
    return df.dropna(subset=list(columns))


def spatial_clusters(
    trips: DataFrame,
    n_clusters: int = 20,
    fraction: float | None = None,
    seed: int = SEED,
    partitions: int | None = None,
) -> DataFrame:
    """k-means on pickup positions: trips, mean position and mean fare per cluster.

    ``partitions`` spreads the rows over that many tasks before the iterations, which
    read ``trips`` once a round: give them stored.
    """
    columns = ["pickup_latitude", "pickup_longitude"]
    rows = _complete(trips.select(*columns, "fare_amount"), columns)
    if fraction is not None:
        rows = bernoulli(rows, fraction, seed)
    rows = spread(rows, partitions)
    labelled = kmeans(rows, columns, n_clusters, False, seed).assigned(rows, "cluster_id")
    stats = labelled.groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("trip_count"),
        F.avg("pickup_latitude").alias("latitude"),
        F.avg("pickup_longitude").alias("longitude"),
        F.avg("fare_amount").alias("avg_fare"),
    )
    return stats.orderBy(F.desc("trip_count"), "cluster_id")


def trip_segments(
    trips: DataFrame,
    n_segments: int = 5,
    fraction: float | None = None,
    seed: int = SEED,
    partitions: int | None = None,
) -> DataFrame:
    """k-means on standardised fare, distance and duration, with segment means."""
    columns = ["fare_amount", "trip_distance", "trip_duration_minutes"]
    rows = _complete(trips.select(*columns), columns)
    if fraction is not None:
        rows = bernoulli(rows, fraction, seed)
    rows = spread(rows, partitions)
    labelled = kmeans(rows, columns, n_segments, True, seed).assigned(rows, "segment")
    stats = labelled.groupBy("segment").agg(
        F.count(F.lit(1)).alias("customer_count"),
        F.avg("fare_amount").alias("avg_fare"),
        F.avg("trip_distance").alias("avg_distance"),
        F.avg("trip_duration_minutes").alias("avg_duration"),
    )
    return stats.orderBy("segment")


def join_segments(fares: DataFrame, tips: DataFrame) -> DataFrame:
    """Fare groups with the tip rates of the same payment type, hour and distance bucket.

    The tip side has one row per join key, so that no fare group (and its revenue)
    is repeated. A fare group without tip figures gets 0.
    """
    rates = tips.select(*SEGMENT_KEYS, "high_tipper_rate", "no_tip_rate")
    return fares.join(rates, SEGMENT_KEYS, "left").fillna(0.0, subset=SEGMENT_FEATURES)


def segment_inputs(trips: DataFrame) -> DataFrame:
    """``join_segments`` from trips, both sides on the five-way distance buckets."""
    tips = T.tip_behavior_rates(trips, SEGMENT_KEYS, S.DISTANCE_5WAY)
    return join_segments(T.economic_fare_analysis(trips), tips)


def customer_segments(inputs: DataFrame, k: int = 4, seed: int = SEED) -> DataFrame:
    """k-means (standardised) over ``segment_inputs``; means and revenue per segment.

    The inputs are read several times; give them stored or from stored state.
    """
    inputs = _complete(inputs, SEGMENT_FEATURES)
    labelled = kmeans(inputs, SEGMENT_FEATURES, k, True, seed).assigned(inputs, "segment")
    stats = labelled.groupBy("segment").agg(
        *[F.avg(c).alias(c) for c in SEGMENT_FEATURES if c != "total_revenue"],
        F.sum("total_revenue").alias("total_revenue"),
        F.count(F.lit(1)).alias("group_count"),
    )
    return stats.orderBy("segment")
