"""Exact quantiles by bins against one map of all values, and against sorting."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from curbline.functions import columns as C
from curbline.operators import quantiles

SHARES = (0.0, 0.001, 0.25, 0.5, 0.99, 1.0)


def wanted(*names):
    return {f"{c}@{p}": (F.col(c), p) for c in names for p in SHARES}


def test_all_distinct_values(spark):
    base = spark.range(60_000).select((F.xxhash64("id") / 1e9).alias("flat"), F.exp(F.xxhash64("id") / 1e17).alias("steep"))
    got = quantiles.exact_quantiles(base, wanted("flat", "steep"))
    for c in ("flat", "steep"):
        want = base.agg(C.quantile(c, list(SHARES)).alias("q")).first()["q"]
        assert [got[f"{c}@{p}"] for p in SHARES] == want
        values = np.sort(base.select(c).toPandas()[c].to_numpy())
        assert [got[f"{c}@{p}"] for p in SHARES] == [values[max(math.ceil(p * 60_000), 1) - 1] for p in SHARES]


def test_no_group_holds_more_than_the_bins(spark, monkeypatch):
    """With a small ``REST`` every step still ends, in bins of equal or few values."""
    monkeypatch.setattr(quantiles, "REST", 3)
    frame = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.xxhash64("id") / 1e12).alias("v"))
    seen, counted = [], quantiles._counted

    def noted(df, scopes):
        bins = counted(df, scopes)
        seen.append(max(len(b) for b in bins.values()))
        return bins

    monkeypatch.setattr(quantiles, "_counted", noted)
    got = quantiles.exact_quantiles(frame, wanted("v"))
    assert [got[f"v@{p}"] for p in SHARES] == frame.agg(C.quantile("v", list(SHARES)).alias("q")).first()["q"]
    assert max(seen) <= quantiles.BINS + 3 and len(seen) <= 8


def test_hot_neighbouring_and_extreme_values(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "REST", 1)
    near = [1.0, math.nextafter(1.0, 2), math.nextafter(math.nextafter(1.0, 2), 2)]
    ends = [-1.7e308, 1.7e308, 5e-324, 0.0]
    for values in (near * 5, ends * 3, near + ends + [1e-300, 1e300] * 4, [2.0] * 9):
        frame = spark.createDataFrame([(v,) for v in values], "v double")
        got = quantiles.exact_quantiles(frame, wanted("v"))
        ordered = sorted(values)
        assert [got[f"v@{p}"] for p in SHARES] == [ordered[max(math.ceil(p * len(values)), 1) - 1] for p in SHARES]


def test_nulls_nan_and_infinity(spark):
    frame = spark.createDataFrame([(v, None, 3) for v in (None, math.nan, math.inf, -math.inf, 1.0, 2.0)], "v double, none double, i int")
    got = quantiles.exact_quantiles(
        frame, {"least": (F.col("v"), 0.0), "mid": (F.col("v"), 0.5), "inf": (F.col("v"), 0.8), "top": (F.col("v"), 1.0), "none": (F.col("none"), 0.5), "i": (F.col("i"), 0.5)}
    )
    assert math.isnan(got.pop("top"))
    assert got == {"least": -math.inf, "mid": 2.0, "inf": math.inf, "none": None, "i": 3.0}
    assert quantiles.exact_quantiles(frame.limit(0), {"v": (F.col("v"), 0.5)}) == {"v": None}


@pytest.mark.parametrize("partitions", [1, 7])
def test_partitions_do_not_matter(spark, partitions):
    frame = spark.range(5_000).select(F.sqrt("id").alias("v")).repartition(partitions)
    assert quantiles.exact_quantiles(frame, {"m": (F.col("v"), 0.5)})["m"] == math.sqrt(2499)
