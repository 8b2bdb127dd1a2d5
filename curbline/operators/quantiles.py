"""Exact quantiles of any numbers by counting bins, in place of one map of all values."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 1_000
#: Values that the last step orders within one group.
REST = 10_000
# places outside the bins, in the order of the values
_LEAST, _GREATEST, _NAN = -1, BINS, BINS + 1


def _bin(v: Column, low: float, high: float) -> Column:
    """Bin of a finite value between ``low`` and ``high``; equal widths, so order is kept."""
    half = 0.5 if math.isinf(high - low) else 1.0
    share = (v * half - low * half) / (high * half - low * half)
    return F.least(F.floor(share * BINS).cast("int"), F.lit(BINS - 1))


def _place(v: Column, bounds: tuple[float, float] | None) -> Column:
    inside = F.lit(0) if bounds is None or bounds[0] == bounds[1] else _bin(v, *bounds)
    infinite = F.when(F.isnan(v), _NAN).when(v == math.inf, _GREATEST).when(v == -math.inf, _LEAST)
    return infinite.otherwise(inside)


def _within(v: Column, bounds: tuple[float, float] | None) -> Column:
    return v.isNotNull() if bounds is None else v.between(*bounds)


def exact_quantiles(df: DataFrame, wanted: dict[str, tuple[Column, float]]) -> dict[str, float | None]:
    """Name -> smallest value whose cumulative share reaches p, for (column, p) each.

    NULL cells do not count; a column of none gives None. NaN is greater than any
    number. Each step counts at most ``BINS`` + 3 bins a name, in one pass for all
    names, and goes on with the bin that holds the quantile, until it holds equal values
    or at most ``REST``, which are then ordered. A step cuts the range to a thousandth,
    so two to four steps are usual; values spread over many powers of ten can take one
    for every three of these. ``df`` is read once a step: give it stored rows.
    """
    values = {name: c.cast("double") for name, (c, _) in wanted.items()}
    found: dict[str, float | None] = {}
    bounds: dict[str, tuple[float, float] | None] = dict.fromkeys(wanted)
    ranks: dict[str, int] = {}
    rest: list[str] = []
    open_names = list(wanted)
    while open_names:
        counted = _counted(df, {n: (values[n], bounds[n]) for n in open_names})
        still = []
        for name in open_names:
            bins = counted.get(name, [])
            if not bins:
                found[name] = None
                continue
            if name not in ranks:
                ranks[name] = max(math.ceil(wanted[name][1] * sum(b["n"] for b in bins)), 1) - 1
            for b in bins:
                if ranks[name] < b["n"]:
                    break
                ranks[name] -= b["n"]
            if b["low"] == b["high"] or math.isnan(b["low"]):
                found[name] = b["low"]
                continue
            bounds[name] = (b["low"], b["high"])
            (rest if b["n"] <= REST else still).append(name)
        open_names = still
    if rest:
        found |= _ordered(df, {n: (values[n], bounds[n], ranks[n]) for n in rest})
    return found


def _long(df: DataFrame, rows: dict[str, Column], kept: Column) -> DataFrame:
    """A row for each (name, cell) that is kept."""
    return df.select(F.inline(F.array(*rows.values()))).where(kept)


def _counted(df: DataFrame, scopes) -> dict[str, list]:
    """Name -> its bins within bounds, in order: how many values, the least and the greatest."""
    rows = {
        name: F.struct(F.lit(name).alias("name"), v.alias("v"), F.when(_within(v, b), _place(v, b)).alias("k"))
        for name, (v, b) in scopes.items()
    }
    groups = _long(df, rows, F.col("k").isNotNull()).groupBy("name", "k")
    counted = groups.agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).collect()
    bins: dict[str, list] = {}
    for row in sorted(counted, key=lambda r: r["k"]):
        bins.setdefault(row["name"], []).append(row)
    return bins


def _ordered(df: DataFrame, scopes) -> dict[str, float]:
    """The value of each rank among the at most ``REST`` values within bounds."""
    rows = {
        name: F.struct(F.lit(name).alias("name"), F.when(_within(v, b), v).alias("v"), F.lit(rank).alias("rank"))
        for name, (v, b, rank) in scopes.items()
    }
    groups = _long(df, rows, F.col("v").isNotNull()).groupBy("name", "rank")
    ordered = groups.agg(F.sort_array(F.collect_list("v")).alias("all"))
    return {r["name"]: r["v"] for r in ordered.select("name", F.get("all", F.col("rank").cast("int")).alias("v")).collect()}
