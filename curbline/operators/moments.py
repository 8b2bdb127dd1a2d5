"""Sums and products of trip variables: correlations, market shares and the linear fare
model without reading a trip.

``moments`` is a grouped pass over trips; its rows add up, so they serve as state of a
month, of a vendor and of each side of the split between training and test.
"""

from __future__ import annotations

from itertools import combinations_with_replacement

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curbline.functions import ridge
from curbline.operators import models
from curbline.operators.economic import CORRELATED
from curbline.operators.sampling import on_test_side

VARIABLES = [*models.FEATURES, "trip_duration_minutes", models.LABEL]
#: Products are taken of differences from these points, so that what coordinates and years
#: have in common does not use up the digits.
CENTRES = {
    "pickup_latitude": 40.75, "pickup_longitude": -73.95, "dropoff_latitude": 40.75, "dropoff_longitude": -73.95,
    "pickup_hour": 12, "pickup_day_of_week": 4, "pickup_month": 6, "pickup_year": 2015,
}
PAIRS = list(combinations_with_replacement(range(len(VARIABLES)), 2))


def _sum(i: int) -> str:
    return f"sum_{VARIABLES[i]}"


def _product(i: int, j: int) -> str:
    i, j = sorted((i, j))
    return f"product_{VARIABLES[i]}__{VARIABLES[j]}"


MEASURES = ["n", "sum_total", *[_sum(i) for i in range(len(VARIABLES))], *[_product(i, j) for i, j in PAIRS]]


def moments(trips: DataFrame, keys=()) -> DataFrame:
    """Per group, vendor and side of the split: trips, revenue, and the sums and products
    of ``VARIABLES`` about ``CENTRES``. Trips that lack one of these are left out."""
    side = on_test_side(models.SPLIT_KEY).alias("is_test")
    centred = [(F.col(v).cast("double") - F.lit(float(CENTRES.get(v, 0)))).alias(f"x{i}") for i, v in enumerate(VARIABLES)]
    rows = models.with_calendar_features(trips).dropna(subset=VARIABLES)
    rows = rows.select(*keys, F.col("VendorID").alias("vendor_id"), side, "total_amount", *centred)
    return rows.groupBy(*keys, "vendor_id", "is_test").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("total_amount").alias("sum_total"),
        *[F.sum(f"x{i}").alias(_sum(i)) for i in range(len(VARIABLES))],
        *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(_product(i, j)) for i, j in PAIRS],
    )


def added(state: DataFrame, *keys) -> DataFrame:
    return state.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in MEASURES])


def correlations(state: DataFrame, columns=CORRELATED) -> DataFrame:
    """``economic.correlations`` of columns among ``VARIABLES``."""

    def spread(a: str, b: str):
        i, j = VARIABLES.index(a), VARIABLES.index(b)
        return F.col(_product(i, j)) - F.try_divide(F.col(_sum(i)) * F.col(_sum(j)), F.col("n"))

    def cell(a: str, b: str):
        return F.lit(1.0) if a == b else F.try_divide(spread(a, b), F.sqrt(spread(a, a) * spread(b, b)))

    cells = [F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), cell(a, b).alias("corr")) for a in columns for b in columns]
    return added(state).select(F.inline(F.array(*cells)))


def market_share(state: DataFrame) -> DataFrame:
    """``economic.market_share``; one row a vendor goes through the window."""
    fare = _sum(VARIABLES.index(models.LABEL))
    return added(state, "vendor_id").select(
        "vendor_id",
        F.col("n").alias("trip_count"),
        (F.col(fare) / F.col("n") + CENTRES.get(models.LABEL, 0)).alias("avg_fare"),
        (F.col("sum_total") / F.col("n")).alias("avg_total"),
        (F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy())).alias("market_share_percent"),
    ).orderBy(F.desc("trip_count"), "vendor_id")


def _sides(state: DataFrame) -> dict[bool, ridge.Sums]:
    """Sums of features and label on either side: two rows, whatever the data."""
    kept = [VARIABLES.index(v) for v in [*models.FEATURES, models.LABEL]]
    out = {side: ridge.Sums(0, np.zeros(len(kept)), np.zeros((len(kept),) * 2)) for side in (False, True)}
    for r in added(state, "is_test").collect():
        products = np.array([[r[_product(i, j)] for j in kept] for i in kept])
        out[r["is_test"]] = ridge.Sums(r["n"], np.array([r[_sum(i)] for i in kept]), products)
    return out


def fare_line(state: DataFrame, regularization: float = ridge.REGULARIZATION) -> tuple[ridge.Line | None, models.FareModel]:
    """The linear model of the training side and its metrics on the other: those of
    ``models.train(..., "linear_regression")``, but for the mean absolute error, which
    sums do not tell."""
    sides = _sides(state)
    line, test = ridge.solved(sides[False], regularization), sides[True]
    measured = models.FareModel("linear_regression", None, training_rows=int(sides[False].n), test_rows=int(test.n))
    if line is not None and test.n:
        measured.rmse = float(np.sqrt(max(0.0, line.squared_error(test)) / test.n))
        variance = test.spread()[-1, -1]
        measured.r2 = float(1 - measured.rmse**2 / variance) if variance > 0 else None
    return line, measured


def fare_coefficients(spark: SparkSession, line: ridge.Line | None) -> DataFrame:
    """(feature, coefficient, importance), the intercept among the features with no
    importance; no rows without a line."""
    if line is None:
        return spark.createDataFrame([], "feature string, coefficient double, importance double")
    share = np.abs(line.standard) / (np.abs(line.standard).sum() or 1.0)
    centres = np.array([CENTRES.get(v, 0) for v in models.FEATURES])
    intercept = line.intercept - float(line.coefficients @ centres) + CENTRES.get(models.LABEL, 0)
    rows = [(f, float(c), float(s)) for f, c, s in zip(models.FEATURES, line.coefficients, share, strict=True)]
    return spark.createDataFrame([*rows, ("intercept", intercept, None)], "feature string, coefficient double, importance double")
