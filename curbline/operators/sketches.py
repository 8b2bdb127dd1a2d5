"""Quantiles of numbers without a grid, from sketches that merge.

Counts per distinct value grow with the rows where nearly every value differs, as
ratios and speeds do. A sketch keeps about three times ``SIZE`` of a month's values and
answers with values whose rank is off by at most ``RANK_ERROR`` (as a share of the rows),
also after any number of merges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline.functions import columns as C

SIZE = 400
#: Twice the error that a rank keeps to in 99 of 100 cases, as KLL sketches are published.
RANK_ERROR = 2 * 2.296 / SIZE**0.9723


def measures() -> dict[str, Column]:
    """Name -> number of a cleaned trip; NULL and NaN are not counted."""
    numbers = {
        "minutes": F.col("trip_duration_minutes"),
        "fare_per_mile": C.per_mile(),
        "miles_per_hour": F.try_divide(F.col("trip_distance") * 60, F.col("trip_duration_minutes")),
        "tip_percent": C.tip_percent(),
    }
    return {name: F.when(~F.isnan(v), v) for name, v in numbers.items()}


def sketched(trips: DataFrame, keys: list[str]) -> DataFrame:
    """One sketch a measure for each group, built before the shuffle."""
    return trips.groupBy(*keys).agg(*[F.kll_sketch_agg_double(v, SIZE).alias(name) for name, v in measures().items()])


def quantiles(sketches: DataFrame, shares: list[float], keys: list[str] = ()) -> DataFrame:
    """(keys, measure, share, n, value) from the merged sketches of each group.

    A measure of no values has n = 0 and the value NULL.
    """
    names = list(measures())
    merged = sketches.groupBy(*keys).agg(*[F.kll_merge_agg_double(name, SIZE).alias(name) for name in names])
    rows = [
        F.struct(
            F.lit(name).alias("measure"),
            F.lit(float(p)).alias("share"),
            F.kll_sketch_get_n_double(name).alias("n"),
            F.when(F.kll_sketch_get_n_double(name) > 0, F.kll_sketch_get_quantile_double(name, F.lit(float(p)))).alias("value"),
        )
        for name in names
        for p in shares
    ]
    return merged.select(*keys, F.inline(F.array(*rows)))


def checked(trips: DataFrame, found: DataFrame) -> DataFrame:
    """(measure, share, n, within): whether the true ranks of the ``value`` of ``found``
    meet its share within ``RANK_ERROR``. Ties give a value several ranks."""
    rows = F.array(*[F.struct(F.lit(name).alias("measure"), v.alias("v")) for name, v in measures().items()])
    cells = trips.select(F.inline(rows)).where("v IS NOT NULL")
    below = F.count_if(F.col("v") < F.col("value")) / F.count(F.lit(1))
    upto = F.count_if(F.col("v") <= F.col("value")) / F.count(F.lit(1))
    told = cells.join(found, "measure").groupBy("measure", "share", "n").agg(below.alias("below"), upto.alias("upto"))
    right = (F.col("below") <= F.col("share") + RANK_ERROR) & (F.col("upto") >= F.col("share") - RANK_ERROR)
    return told.select("measure", "share", "n", right.alias("within"))
