"""Unusual rows of an aggregate table: robust scores, or an isolation forest."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline.functions import columns as C
from curbline.operators import quantiles

SHARE = 0.01
NORMAL_MAD = 1.4826  # deviation of a normal variable in units of its MAD
DEMAND_FEATURES = ["trip_count", "avg_fare"]
ROUTE_FEATURES = ["avg_distance", "avg_duration"]


def _quantiles(df: DataFrame, wanted: dict[str, float], accuracy: int | None) -> dict[str, float | None]:
    """Column -> its value at a cumulative share, exactly or by a sketch."""
    if accuracy is None:
        return quantiles.exact_quantiles(df, {name: (F.col(name), p) for name, p in wanted.items()})
    return df.agg(*[C.quantile(name, p, accuracy).alias(name) for name, p in wanted.items()]).first().asDict()


def _flag_top(scored: DataFrame, score: str, share: float, accuracy: int | None = None) -> DataFrame:
    """Rows at or above the (1 - share) quantile of the score."""
    cut = _quantiles(scored, {score: 1.0 - share}, accuracy)[score]
    return scored.where(F.col(score) >= F.lit(cut))


def robust_scores(df: DataFrame, features, accuracy: int | None = None) -> DataFrame:
    """Adds ``score``: the largest distance from a feature's median, in robust
    deviations (1.4826 * median absolute deviation; the standard deviation where
    that is 0; 0 where both are).

    Medians are exact, found by counting bins (``quantiles.exact_quantiles``), so ``df``
    is read a few times: give it stored rows. ``accuracy`` makes them sketches of bounded
    size, with a rank error of rows / accuracy, in a pass each.
    """
    measured = df.withColumns({f"_x_{f}": F.col(f).cast("double") for f in features})
    centres = _quantiles(measured, {f"_x_{f}": 0.5 for f in features}, accuracy)
    placed = measured.withColumns({f"_d_{f}": F.abs(F.col(f"_x_{f}") - F.lit(centres[f"_x_{f}"])) for f in features})
    mads = _quantiles(placed, {f"_d_{f}": 0.5 for f in features}, accuracy)
    stds = df.agg(*[F.stddev(f).alias(f) for f in features]).first()

    def part(f: str) -> Column:
        mad = (mads[f"_d_{f}"] or 0.0) * NORMAL_MAD
        return F.coalesce(F.try_divide(F.col(f"_d_{f}"), F.lit(mad if mad > 0 else stds[f])), F.lit(0.0))

    scored = placed.withColumn("score", F.greatest(*[part(f) for f in features], F.lit(0.0)))
    return scored.select(*df.columns, "score")


def robust_anomalies(df: DataFrame, features, share: float = SHARE, accuracy: int | None = None) -> DataFrame:
    """The most unusual ``share`` of rows by robust score (ties at the cut included)."""
    return _flag_top(robust_scores(df, features, accuracy), "score", share, accuracy)


# ---- isolation forest -------------------------------------------------------------


def _mean_depth(rows: int) -> float:
    """Mean depth of an unsuccessful search among that many rows."""
    if rows < 2:
        return 0.0
    if rows == 2:
        return 1.0
    return 2.0 * (math.log(rows - 1) + np.euler_gamma) - 2.0 * (rows - 1) / rows


def _grow(points: np.ndarray, seed: int, limit: int) -> list[tuple]:
    """Random axis-parallel splits: (node, feature, cut, left, right, depth)."""
    rng = np.random.default_rng(seed)
    nodes, todo, made = [], [(0, points, 0)], 1
    while todo:
        node, rows, depth = todo.pop()
        low, high = (rows.min(axis=0), rows.max(axis=0)) if len(rows) else (None, None)
        open_axes = np.flatnonzero(high > low) if len(rows) > 1 else []
        if depth >= limit or len(open_axes) == 0:
            nodes.append((node, -1, 0.0, -1, -1, depth + _mean_depth(len(rows))))
            continue
        axis = int(rng.choice(open_axes))
        cut = float(rng.uniform(low[axis], high[axis]))
        below = rows[:, axis] <= cut
        nodes.append((node, axis, cut, made, made + 1, 0.0))
        todo += [(made, rows[below], depth + 1), (made + 1, rows[~below], depth + 1)]
        made += 2
    return nodes


def isolation_forest(
    df: DataFrame,
    features,
    key_columns,
    share: float = SHARE,
    trees: int = 100,
    rows_per_tree: int = 256,
    seed: int = 42,
) -> DataFrame:
    """The ``share`` of rows that random splits isolate soonest, with their ``score``.

    Each tree grows in its own task from about ``rows_per_tree`` hashed rows. The
    grown trees are at most ``trees * 2 * rows_per_tree`` small nodes in all;
    they go to every task, and all rows are scored there in Arrow batches.
    """
    features = list(features)
    total = df.count()
    if total == 0:
        return df.withColumn("score", F.lit(None).cast("double"))
    point = [F.col(f).cast("double").alias(f"f{i}") for i, f in enumerate(features)]
    digest = F.xxhash64(F.lit(seed), *[F.col(c) for c in key_columns])
    pool_rows = trees * rows_per_tree
    unit = F.lit(1 << 30)
    pool_share = min(1.0, pool_rows / total)
    pool = df.select(*point, digest.alias("d")).dropna().where(F.pmod(F.col("d"), unit) < F.lit(int((1 << 30) * pool_share)))
    drawn_share = min(1.0, rows_per_tree / min(total, pool_rows))
    drawn = pool.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))).where(
        F.pmod(F.xxhash64("d", "tree"), unit) < F.lit(int((1 << 30) * drawn_share))
    )
    limit = math.ceil(math.log2(max(rows_per_tree, 2)))
    names = [f"f{i}" for i in range(len(features))]

    def grow(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        # the order of arrival must not matter
        rows = group.sort_values(names)[names].to_numpy()
        tree = int(key[0])
        nodes = pd.DataFrame(_grow(rows, seed + tree, limit), columns=["node", "axis", "cut", "lo", "hi", "path"])
        return nodes.assign(tree=tree)[["tree", "node", "axis", "cut", "lo", "hi", "path"]]

    grown = drawn.groupBy("tree").applyInPandas(
        grow, "tree int, node int, axis int, cut double, lo int, hi int, path double"
    )
    forest = [g.sort_values("node").reset_index(drop=True) for _, g in grown.toPandas().groupby("tree")]
    packed = [tuple(g[c].to_numpy() for c in ("axis", "cut", "lo", "hi", "path")) for g in forest]
    normal = _mean_depth(min(rows_per_tree, total)) or 1.0

    @F.pandas_udf("double")
    def score(*columns: pd.Series) -> pd.Series:
        points = np.column_stack([c.to_numpy(dtype=float) for c in columns])
        depth = np.zeros(len(points))
        for axis, cut, lo, hi, path in packed:
            at = np.zeros(len(points), dtype=int)
            for _ in range(limit):
                inner = axis[at] >= 0
                if not inner.any():
                    break
                value = points[np.arange(len(points)), np.maximum(axis[at], 0)]
                at = np.where(inner, np.where(value <= cut[at], lo[at], hi[at]), at)
            depth += path[at]
        return pd.Series(np.power(2.0, -depth / max(len(packed), 1) / normal))

    scored = df.withColumn("score", score(*[F.col(f).cast("double") for f in features]))
    return _flag_top(scored, "score", share)


def demand_anomalies(
    hourly: DataFrame, share: float = SHARE, method: str = "robust", accuracy: int | None = None
) -> DataFrame:
    """Unusual hourly rows by trips and mean fare."""
    keys = ["pickup_year", "pickup_month", "pickup_day_of_week", "pickup_hour"]
    return _detect(hourly, DEMAND_FEATURES, keys, share, method, accuracy)


def route_anomalies(
    routes: DataFrame, share: float = SHARE, method: str = "robust", accuracy: int | None = None
) -> DataFrame:
    """Unusual routes by mean distance and duration."""
    keys = ["pickup_lat_grid", "pickup_lon_grid", "dropoff_lat_grid", "dropoff_lon_grid", "pickup_year", "pickup_month"]
    return _detect(routes, ROUTE_FEATURES, keys, share, method, accuracy)


def _detect(df: DataFrame, features, keys, share: float, method: str, accuracy: int | None) -> DataFrame:
    if method == "robust":
        return robust_anomalies(df, features, share, accuracy)
    if method == "forest":
        return isolation_forest(df, features, keys, share)
    raise ValueError(f"unknown method {method!r}")
