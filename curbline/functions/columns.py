"""Scalar expressions over trip columns. All are built-in Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from curbline import schema as S

PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"


def _col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def trip_minutes(start=PICKUP, end=DROPOFF) -> Column:
    """Whole seconds between two timestamps, as minutes."""
    return (F.unix_timestamp(_col(end)) - F.unix_timestamp(_col(start))) / F.lit(60.0)


def grid(coordinate, digits: int = 2) -> Column:
    """Cell of a decimal grid: the coordinate rounded to ``digits`` places."""
    return F.round(_col(coordinate), digits)


def grid_index(coordinate, size: float) -> Column:
    """Integer cell number of a grid with cells of ``size`` degrees."""
    return F.round(_col(coordinate) / F.lit(float(size))).cast("long")


def grid_centre(index, size: float) -> Column:
    return _col(index) * F.lit(float(size))


def bucket(value, edges, labels) -> Column:
    """Label of the first edge the value lies below; the last label otherwise."""
    value = _col(value)
    chain = F.when(value < F.lit(edges[0]), labels[0])
    for edge, label in zip(edges[1:], labels[1:]):
        chain = chain.when(value < F.lit(edge), label)
    return chain.otherwise(labels[-1])


def distance_band(distance="trip_distance") -> Column:
    """Finest distance band (0 .. 5); see ``band_bucket``."""
    edges = S.DISTANCE_BAND_EDGES
    return bucket(distance, edges, [F.lit(i) for i in range(len(edges) + 1)])


def band_bucket(band, scheme) -> Column:
    """Label of a distance scheme from the fine band, without the distance."""
    edges, labels = scheme
    in_bands = [S.DISTANCE_BAND_EDGES.index(e) + 1 for e in edges]
    return bucket(band, in_bands, labels)


def hour_bucket(hour="pickup_hour") -> Column:
    hour = _col(hour)
    chain = None
    for label, first, last in S.HOUR_BUCKETS:
        inside = hour.between(first, last)
        chain = F.when(inside, label) if chain is None else chain.when(inside, label)
    return chain.otherwise(S.HOUR_BUCKET_REST)


def is_weekend(day_of_week="pickup_day_of_week") -> Column:
    return _col(day_of_week).isin(*S.WEEKEND_DAYS)


def tip_percent(tip="tip_amount", fare="fare_amount", guarded: bool = True) -> Column:
    """Tip as percent of fare. Guarded: 0 unless fare > 0; else NULL on zero fare."""
    tip, fare = _col(tip), _col(fare)
    ratio = F.try_divide(tip, fare) * F.lit(100)
    return F.when(fare > 0, ratio).otherwise(F.lit(0.0)) if guarded else ratio


def per_mile(amount="fare_amount", distance="trip_distance") -> Column:
    """Amount per mile; NULL unless the distance is positive."""
    distance = _col(distance)
    return F.when(distance > 0, _col(amount) / distance)


def route_point(lat, lon) -> Column:
    """``"lat,lon"`` with two fixed decimals."""
    return F.concat_ws(",", F.format_string("%.2f", _col(lat)), F.format_string("%.2f", _col(lon)))


def day_key(ts=PICKUP) -> Column:
    return F.date_format(_col(ts), "yyyy-MM-dd")


def haversine_miles(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance between two points given in degrees."""
    p1, p2 = F.radians(_col(lat1)), F.radians(_col(lat2))
    half_lat = (p2 - p1) / F.lit(2)
    half_lon = (F.radians(_col(lon2)) - F.radians(_col(lon1))) / F.lit(2)
    chord = F.pow(F.sin(half_lat), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(half_lon), 2)
    return F.lit(2.0 * S.EARTH_RADIUS_MILES) * F.asin(F.sqrt(F.least(chord, F.lit(1.0))))


def z_score(value, mean, std) -> Column:
    """(value - mean) / std, and 0 where the spread is unknown or zero."""
    std = _col(std)
    return F.when(std.isNull() | (std == 0), F.lit(0.0)).otherwise((_col(value) - _col(mean)) / std)


def at_least(value, floor: float) -> Column:
    """Clip from below (for divisors); NULL stays NULL."""
    value = _col(value)
    return F.when(value < F.lit(floor), F.lit(floor)).otherwise(value)


def bin_index(value, low, width, bins: int) -> Column:
    """Histogram bin of a value; the last bin includes its upper end."""
    raw = F.floor((_col(value) - low) / width).cast("int")
    return F.least(raw, F.lit(bins - 1))


def months_spanned(first, last) -> Column:
    """Calendar months touched by a date range, both ends included."""
    first, last = _col(first), _col(last)
    years = F.year(last) - F.year(first)
    return years * 12 + (F.month(last) - F.month(first)) + 1


def quantile(value: str, p, accuracy: int | None = None) -> Column:
    """Value at cumulative share ``p`` (a number or a list of numbers).

    The default is exact; its state is the distinct values with their counts,
    merged map-side, which stays small for cleaned trips (money in cents below
    500 dollars, distances in hundredths below 100 miles, durations in seconds
    below 3 hours). Give ``accuracy`` for columns without such a grid: the
    rank error is then at most rows / accuracy and the state is bounded.
    """
    probs = f"array({', '.join(repr(float(x)) for x in p)})" if isinstance(p, (list, tuple)) else repr(float(p))
    if accuracy:
        return F.expr(f"percentile_approx(`{value}`, {probs}, {int(accuracy)})")
    return F.expr(f"percentile_disc({probs}) WITHIN GROUP (ORDER BY `{value}`)")
