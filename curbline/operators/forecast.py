"""Hourly demand forecasts from lagged counts.

The series is chronological: trips per hour, gaps filled with 0, for the whole
city or per zone. Every lag is at least as long as the horizon, so each of the
next 24 hours is predicted directly from known counts, for all zones at once.
This replaces a seasonal ARIMA of one series; judge it by ``backtest``.

The operators read the hourly series several times; give them a stored one
(``session.settled``) when it comes from trips.

``start`` and ``end`` (text or timestamps, half-open, whole hours) bound the series
and set its origin, the hour before ``end``. Give them wherever a stray date may have
survived cleaning: without ``end`` the last trip, however far off, is the origin.
"""

from __future__ import annotations

from itertools import combinations_with_replacement

import numpy as np
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from curbline.functions import columns as C
from curbline.functions import ridge

DAY, WEEK = 24, 168
LAGS = (DAY, 2 * DAY, WEEK)


def hourly_demand(trips: DataFrame, zone_columns=(), ts: str = C.PICKUP, start=None, end=None) -> DataFrame:
    """Trips per (zone and) clock hour that has any, from ``start`` to before ``end``."""
    hour = F.date_trunc("hour", F.col(ts)).cast("timestamp").alias("hour_start")
    if start is not None:
        trips = trips.where(F.col(ts) >= F.lit(start).cast(trips.schema[ts].dataType))
    if end is not None:
        trips = trips.where(F.col(ts) < F.lit(end).cast(trips.schema[ts].dataType))
    return trips.groupBy(*zone_columns, hour).agg(F.count(F.lit(1)).alias("trip_count"))


def _within(demand: DataFrame, start=None, end=None) -> DataFrame:
    if start is not None:
        demand = demand.where(F.col("hour_start") >= F.lit(start).cast("timestamp"))
    if end is not None:
        demand = demand.where(F.col("hour_start") < F.lit(end).cast("timestamp"))
    return demand


def _origin(demand: DataFrame, end=None) -> Column:
    """Last hour of the series, of all zones alike."""
    if end is not None:
        return _later(F.date_trunc("hour", F.lit(end).cast("timestamp")), -1)
    return demand.agg(F.max("hour_start").alias("h")).scalar()


def _later(hour: Column, hours) -> Column:
    shift = hours if isinstance(hours, Column) else F.lit(hours)
    return F.timestamp_seconds(F.unix_timestamp(hour) + shift * 3600)


def seasonal_naive_forecast(demand: DataFrame, zone_columns=(), horizon: int = DAY, start=None, end=None) -> DataFrame:
    """Each coming hour repeats the count of the same hour a week before.

    The last hour of the whole series is the origin for every zone; a zone
    without trips in the matching hour gets 0.
    """
    demand = _within(demand, start, end)
    last = _origin(demand, end)
    zones = demand.groupBy(*zone_columns).agg(F.max("hour_start").alias("zone_last"))
    ahead = zones.select(*zone_columns, F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("hour_ahead"))
    slots = ahead.withColumn("target", _later(last, F.col("hour_ahead"))).withColumn(
        "hour_start", _later(F.col("target"), -WEEK)
    )
    week = demand.where(F.col("hour_start") > _later(last, -WEEK))
    joined = slots.join(week, [*zone_columns, "hour_start"], "left")
    return joined.select(
        *zone_columns,
        "hour_ahead",
        F.col("target").alias("hour_start"),
        F.coalesce("trip_count", F.lit(0)).alias("predicted_trips"),
    )


def with_lags(
    demand: DataFrame, zone_columns=(), horizon: int = DAY, history: int | None = None, start=None, end=None
) -> DataFrame:
    """Gap-free hourly rows per zone up to ``horizon`` hours ahead, with lagged counts.

    A zone starts at its first trip, or ``history`` hours before the end if that
    is later. Coming hours have no ``trip_count``. Zones are equal in size here
    (one row per hour), however unequal in trips.
    """
    demand = _within(demand, start, end)
    last = _origin(demand, end)
    zones = demand.groupBy(*zone_columns).agg(F.min("hour_start").alias("first")).withColumn("last", last)
    start = F.col("first")
    if history is not None:
        earliest = _later(F.col("last"), 1 - history)
        start = F.greatest(start, earliest)
        demand = demand.where(F.col("hour_start") >= _later(last, 1 - history))
    hours = F.sequence(start, _later(F.col("last"), horizon), F.expr("INTERVAL 1 HOUR"))
    spine = zones.select(*zone_columns, "last", F.explode(hours).alias("hour_start"))
    filled = spine.join(demand, [*zone_columns, "hour_start"], "left").withColumn(
        "trip_count",
        F.when(F.col("hour_start") <= F.col("last"), F.coalesce("trip_count", F.lit(0))).cast("double"),
    )
    order = Window.partitionBy(*zone_columns).orderBy("hour_start")
    return filled.withColumns(
        {
            **{f"lag_{n}": F.lag("trip_count", n).over(order) for n in LAGS},
            "hour_ahead": ((F.unix_timestamp("hour_start") - F.unix_timestamp("last")) / 3600).cast("int"),
        }
    ).where(F.col(f"lag_{WEEK}").isNotNull())


_LAG_NAMES = [f"lag_{n}" for n in LAGS]
#: Variables of the regression: lags, flags of the hours 1 to 23 and the weekdays 2 to 7
#: (hour 0 and Sunday have none), and the trips to predict.
_HOURS, _DAYS = range(1, 24), range(2, 8)


def _slots(rows: DataFrame) -> DataFrame:
    """Sums and products of trips and lags per hour of day and weekday: 168 rows at most,
    from one pass over all zones."""
    seen = [*_LAG_NAMES, "trip_count"]
    pairs = list(combinations_with_replacement(seen, 2))
    known = rows.where(F.col("trip_count").isNotNull())
    return known.groupBy(F.hour("hour_start").alias("hour"), F.dayofweek("hour_start").alias("day")).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(c).alias(c) for c in seen],
        *[F.sum(F.col(x) * F.col(y)).alias(f"{x}*{y}") for x, y in pairs],
    )


def _added(slots: list[Row]) -> ridge.Sums:
    """Sums and products of all variables. Within a slot a flag is constant, so whatever
    holds one is the slot's number or sum of the rest."""
    seen = [*_LAG_NAMES, "trip_count"]
    size = len(LAGS) + len(_HOURS) + len(_DAYS) + 1
    counted = [*range(len(LAGS)), size - 1]
    n, sums, products = 0, np.zeros(size), np.zeros((size, size))
    for r in slots:
        flags = np.zeros(size)
        flags[len(LAGS) : -1] = [r["hour"] == h for h in _HOURS] + [r["day"] == d for d in _DAYS]
        own = np.zeros(size)
        own[counted] = [r[c] for c in seen]
        n += r["n"]
        sums += own + r["n"] * flags
        products += np.outer(own, flags) + np.outer(flags, own) + r["n"] * np.outer(flags, flags)
        for at, x in zip(counted, seen, strict=True):
            products[at, counted] += [r[f"{x}*{y}" if seen.index(x) <= seen.index(y) else f"{y}*{x}"] for y in seen]
    return ridge.Sums(n, sums, products)


def fit(rows: DataFrame) -> ridge.Line:
    """Linear regression on the lags, hour and weekday, by normal equations: one grouped
    pass, of which the driver sees the sums of 168 slots."""
    line = ridge.solved(_added(_slots(rows).collect()))
    if line is None:
        raise ValueError(f"no hour has the {max(LAGS)} hours of history that the regression needs")
    return line


def predicted(line: ridge.Line) -> Column:
    """Trips that the line expects, 0 at least."""
    w = [float(c) for c in line.coefficients]
    hours, days = w[len(LAGS) : len(LAGS) + len(_HOURS)], w[len(LAGS) + len(_HOURS) :]

    def of(values: list[float], nth: Column) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in [0.0, *values]]), nth)

    total = F.lit(line.intercept) + of(hours, F.hour("hour_start") + 1) + of(days, F.dayofweek("hour_start"))
    for name, c in zip(_LAG_NAMES, w, strict=False):
        total = total + F.lit(c) * F.col(name)
    return F.greatest(total, F.lit(0.0))


def demand_forecast(demand: DataFrame, zone_columns=(), horizon: int = DAY, start=None, end=None) -> DataFrame:
    """Predicted trips for each of the next hours, beside the seasonal naive figure.

    Fitting reads the whole series; predicting needs its last week only.
    """
    if horizon > min(LAGS):
        raise ValueError(f"the horizon may not exceed the shortest lag ({min(LAGS)} hours)")
    model = fit(with_lags(demand, zone_columns, 0, None, start, end))
    ahead = with_lags(demand, zone_columns, horizon, WEEK, start, end).where(F.col("hour_ahead") > 0)
    return ahead.select(
        *zone_columns,
        "hour_ahead",
        "hour_start",
        predicted(model).alias("predicted_trips"),
        F.col(f"lag_{WEEK}").alias("naive_trips"),
    ).orderBy(*zone_columns, "hour_ahead")


def recent_demand(demand: DataFrame, zone_columns=(), hours: int = WEEK, start=None, end=None) -> DataFrame:
    """The last actual hours of every zone, gaps as 0."""
    demand = _within(demand, start, end)
    last = _origin(demand, end)
    zones = demand.groupBy(*zone_columns).agg(F.max("hour_start").alias("zone_last"))
    back = zones.select(*zone_columns, F.explode(F.sequence(F.lit(0), F.lit(hours - 1))).alias("back"))
    slots = back.withColumn("hour_start", _later(last, -F.col("back"))).drop("back")
    week = demand.where(F.col("hour_start") > _later(last, -hours))
    return (
        slots.join(week, [*zone_columns, "hour_start"], "left")
        .withColumn("trip_count", F.coalesce("trip_count", F.lit(0)))
        .orderBy(*zone_columns, "hour_start")
    )


def backtest(demand: DataFrame, zone_columns=(), hours: int = WEEK, start=None, end=None) -> DataFrame:
    """Mean absolute error over the last ``hours``, model against seasonal naive.

    The model is fitted on the hours before; each test hour uses counts at least
    a day old, as a forecast would.
    """
    model = fit(with_lags(demand, zone_columns, 0, None, start, end).where(F.col("hour_ahead") <= -hours))
    tested = with_lags(demand, zone_columns, 0, hours + WEEK, start, end).where(F.col("hour_ahead") > -hours)
    actual = F.col("trip_count")
    return tested.agg(
        F.avg(F.abs(actual - predicted(model))).alias("model_mae"),
        F.avg(F.abs(actual - F.col(f"lag_{WEEK}"))).alias("naive_mae"),
        F.count(F.lit(1)).alias("test_hours"),
    )
