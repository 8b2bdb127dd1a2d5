"""Looking at the data: summary, ranges, histograms, pages, samples of points."""

from __future__ import annotations

from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    NumericType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

from curbline.functions import columns as C
from curbline.functions import filters

# The columns of a page, in order.
PAGE_COLUMNS = [
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "tip_amount",
    "total_amount",
    "payment_type",
    "trip_duration_minutes",
]
MAX_PAGE_SIZE = 1000
# groups one step of the search for a page's start counts, and the rows before a
# page that its final top-n may carry
SEEK_BINS, REST_ROWS = 1000, 10_000


def describe_columns(df: DataFrame, columns=None) -> DataFrame:
    """Count, mean, sample stddev, min and max of every numeric column, one row each."""
    names = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.count(c).alias("count"),
            F.avg(c).alias("mean"),
            F.stddev(c).alias("stddev"),
            F.min(c).cast("double").alias("min"),
            F.max(c).cast("double").alias("max"),
        )
        for c in names
    ]
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def date_range(df: DataFrame, ts: str = C.PICKUP) -> DataFrame:
    """One row: first and last timestamp and their years."""
    span = df.agg(F.min(ts).alias("min_date"), F.max(ts).alias("max_date"))
    return span.select(
        "min_date", "max_date", F.year("min_date").alias("min_year"), F.year("max_date").alias("max_year")
    )


def histogram(
    df: DataFrame, field: str, bins: int = 20, year=None, month=None, digits: int | None = 2
) -> DataFrame:
    """Equal-width histogram between the smallest and the largest value.

    Empty bins are left out; the last bin includes the maximum. The bounds are a
    scalar subquery of the same plan, so nothing is collected. A constant
    column falls into one bin of width 1. ``digits`` rounds the shown bin ends
    (None: not at all).
    """
    df = filters.calendar(df, year, month)
    value = F.col(field).cast("double")
    bounds = df.agg(F.struct(F.min(value).alias("low"), F.max(value).alias("high")).alias("b")).scalar()
    framed = df.where(value.isNotNull()).select(value.alias("v"), bounds.alias("b")).select("v", "b.low", "b.high")
    width = F.when(F.col("high") > F.col("low"), (F.col("high") - F.col("low")) / bins).otherwise(F.lit(1.0))
    counts = (
        framed.withColumn("width", width)
        .groupBy(C.bin_index("v", F.col("low"), F.col("width"), bins).alias("bin"), "low", "width")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    start = F.col("low") + F.col("bin") * F.col("width")
    end = F.col("low") + (F.col("bin") + 1) * F.col("width")
    shown = (lambda edge: edge) if digits is None else (lambda edge: F.round(edge, digits))
    return counts.select(
        "bin",
        shown(start).alias("bin_start"),
        shown(end).alias("bin_end"),
        "count",
        F.concat_ws("-", F.round(start, 1), F.round(end, 1)).alias("label"),
    ).orderBy("bin")


def _least_groups(df: DataFrame, group: Column, n: int) -> DataFrame:
    """Rows of the least groups that hold ``n`` rows together, or all rows if there are fewer.

    Rows before a top-n are cut to these, as a task would ship n rows otherwise, however
    many tasks there are. The cut is a scalar subquery over the counts; ``group`` is a
    whole number, of few enough values for one window over them.
    """
    counts = df.groupBy(group.alias("g")).agg(F.count(F.lit(1)).alias("rows"))
    upto = F.sum("rows").over(Window.orderBy("g").rowsBetween(Window.unboundedPreceding, 0))
    reached = F.min(F.when(F.col("upto") >= n, F.col("g")))
    cut = counts.withColumn("upto", upto).agg(F.coalesce(reached, F.max("g")).alias("cut")).scalar()
    return df.where(group <= cut)


def head_rows(trips: DataFrame, n: int = 100, year=None, month=None) -> DataFrame:
    """First n trips by pickup time (ties by the other displayed columns).

    Only trips up to the hour in which the n-th starts are ordered.
    """
    scoped = filters.calendar(trips, year, month).select(*PAGE_COLUMNS)
    hour = F.coalesce(F.floor(F.unix_seconds(C.PICKUP) / 3600), F.lit(-(2**60)))
    scoped = _least_groups(scoped, hour, n)
    return scoped.orderBy(*_order(scoped, C.PICKUP, "asc")).limit(n)


def scatter(
    df: DataFrame, x_field: str, y_field: str, key_columns, sample_size: int = 1000, year=None, month=None
) -> DataFrame:
    """About random but repeatable points: the rows with the smallest key hashes.

    ``key_columns`` identify a row; the same rows come back whatever the
    partitioning. Only rows under the least power of two that enough hashes lie under
    are ordered: about twice the sample, however many rows and tasks there are.
    """
    df = filters.calendar(df, year, month)
    digest = F.md5(F.concat_ws("-", *[F.col(c).cast("string") for c in key_columns]))
    picked = df.select(digest.alias("h"), F.col(x_field).alias("x"), F.col(y_field).alias("y"))
    bits = F.length(F.conv(F.substring("h", 1, 15), 16, 2))
    top = _least_groups(picked, bits, sample_size).orderBy("h", "x", "y").limit(sample_size)
    return top.select(F.col("x").cast("double").alias(x_field), F.col("y").cast("double").alias(y_field))


# ---- pages --------------------------------------------------------------------


def _directed(column: Column, direction: str) -> Column:
    return column.asc_nulls_first() if direction == "asc" else column.desc_nulls_last()


def _order_names(df: DataFrame, order_by: str | None) -> list[str]:
    first = order_by if order_by and order_by in df.columns else C.PICKUP
    return [first] + [c for c in PAGE_COLUMNS if c != first and c in df.columns]


def checked_direction(direction: str) -> str:
    if direction.lower() not in ("asc", "desc"):
        raise ValueError(f"direction must be asc or desc, not {direction!r}")
    return direction.lower()


def page_offset(page: int, page_size: int) -> int:
    """Rows before a page."""
    if page < 1 or not 1 <= page_size <= MAX_PAGE_SIZE:
        raise ValueError("page starts at 1 and page_size lies between 1 and 1000")
    return (page - 1) * page_size


def _order(df: DataFrame, order_by: str | None, direction: str) -> list[Column]:
    """Chosen column first, then every displayed column, all in one direction.

    Rows equal in all of them look the same, so pages are well defined.
    """
    return [_directed(F.col(c), direction) for c in _order_names(df, order_by)]


def _positions(df: DataFrame, name: str):
    """Numbers that order a column, one after the other, each with the test whether
    they are whole: exact whole numbers, doubles, or a text's code points in turn."""
    kind, column = df.schema[name].dataType, F.col(name)
    if isinstance(kind, (DoubleType, FloatType)):
        yield column.cast("double"), False
    elif isinstance(kind, StringType):
        for at in count(1):  # past its end a text has -1, like every text equal to it
            rest = F.substring(column, at, 1)
            yield F.when(rest == "", F.lit(-1)).otherwise(F.ascii(rest)).cast("decimal(38,0)"), True
    elif isinstance(kind, (TimestampType, TimestampNTZType)):
        yield F.unix_micros(column.cast("timestamp")).cast("decimal(38,0)"), True
    elif isinstance(kind, DateType):
        yield F.unix_date(column).cast("decimal(38,0)"), True
    elif isinstance(kind, DecimalType):
        yield (column * F.lit(10**kind.scale).cast("decimal(38,0)")).cast("decimal(38,0)"), True
    else:
        yield column.cast("decimal(38,0)"), True


def _bin(value: Column, whole: bool, low, high) -> Column:
    """Number of the group a value falls into: one of SEEK_BINS equal widths between
    the bounds, -2 for NULL, -1 and SEEK_BINS for infinities, SEEK_BINS + 1 for NaN.
    Groups are ordered as the values are, also where arithmetic rounds."""
    if low is None:
        inside = F.lit(0)
    elif whole:
        width = max(1, -(-(int(high) - int(low) + 1) // SEEK_BINS))
        step, above = F.lit(width).cast("decimal(38,0)"), value - F.lit(low)
        inside = ((above - above % step) / step).cast("int")
    else:
        # halves where the range itself would overflow; the bounds always part
        part = 2 if high - low == float("inf") else 1
        scale = (high / part - low / part) or 1.0
        inside = F.least(F.floor((value / part - low / part) / scale * SEEK_BINS), F.lit(SEEK_BINS - 1)).cast("int")
    if whole:
        return F.when(value.isNull(), F.lit(-2)).otherwise(inside)
    infinite = F.lit(float("inf"))
    return (
        F.when(value.isNull(), F.lit(-2))
        .when(F.isnan(value), F.lit(SEEK_BINS + 1))
        .when(value == infinite, F.lit(SEEK_BINS))
        .when(value == -infinite, F.lit(-1))
        .otherwise(inside)
    )


def _bounds(value: Column, whole: bool) -> list[Column]:
    finite = value if whole else F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value)
    return [F.min(finite).alias("low"), F.max(finite).alias("high")]


def _seek(df: DataFrame, order_by: str | None, direction: str, offset: int, rest_rows: int):
    """Skip whole groups of rows until at most ``rest_rows`` remain before ``offset``.

    Returns the remaining frame and the offset within it, or None past the end. Each
    step counts the rows of at most SEEK_BINS + 4 groups of equal width and narrows
    the scope to the group the offset falls into, then to the next column where all
    rows of it are equal; so no task sees more than these counts, whatever the
    column holds.
    """
    prefix: list[tuple[Column, int]] = []
    scope, left = df, offset
    for name in _order_names(df, order_by):
        for value, whole in _positions(df, name):
            low = high = None
            ended = left <= rest_rows
            if not ended:
                low, high = scope.agg(*_bounds(value, whole)).first()
            while not ended:
                level = _bin(value, whole, low, high)
                groups = scope.groupBy(level.alias("k")).agg(F.count(F.lit(1)).alias("n"), *_bounds(value, whole)).collect()
                for group in sorted(groups, key=lambda g: g["k"], reverse=direction == "desc"):
                    if left < group["n"]:
                        break
                    left -= group["n"]
                else:
                    return None
                key, low, high = group["k"], group["low"], group["high"]
                prefix.append((level, key))
                scope = scope.where(level == key)
                ended = left <= rest_rows or not 0 <= key < SEEK_BINS or low == high
            if left <= rest_rows or key == -2 or (low is not None and low == high == -1):
                break  # found, or no further position tells these rows apart
        if left <= rest_rows:
            break

    from_here = F.lit(True)
    for level, key in reversed(prefix):
        later = level > key if direction == "asc" else level < key
        from_here = later | ((level == key) & from_here)
    return (df.where(from_here) if prefix else df), left


def explore(
    trips: DataFrame,
    page: int = 1,
    page_size: int = 100,
    order_by: str | None = None,
    order_direction: str = "asc",
    rest_rows: int = REST_ROWS,
    **wanted,
) -> DataFrame:
    """One page of trips under the explorer's filters and order.

    Pages follow one global order (NULL first and NaN last when ascending), so they
    concatenate to the ordered set. Rows before the page are skipped by counting
    groups until at most ``rest_rows`` are left to a final top-n, which therefore
    never carries more; a page further in costs a few more small jobs.
    """
    offset, direction = page_offset(page, page_size), checked_direction(order_direction)
    return rows_from(filters.explorer(trips, **wanted), offset, page_size, order_by, direction, rest_rows)


def rows_from(
    df: DataFrame, offset: int, size: int, order_by: str | None, direction: str, rest_rows: int = REST_ROWS
) -> DataFrame:
    """``size`` rows from ``offset`` on, in the order of pages."""
    order = _order(df, order_by, direction)
    sought = _seek(df, order_by, direction, offset, rest_rows)
    if sought is None:
        return df.select(*PAGE_COLUMNS).limit(0)
    df, offset = sought
    names = list(dict.fromkeys(PAGE_COLUMNS + _order_names(df, order_by)))
    paged = df.select(*names).orderBy(*order).offset(offset).limit(size)
    return paged.select(*PAGE_COLUMNS)


def explore_after(
    trips: DataFrame, last: dict, page_size: int = 100, order_by: str | None = None, order_direction: str = "asc", **wanted
) -> DataFrame:
    """The page after a known last row (its displayed columns as a dict).

    Keyset paging: no prefix is sorted or counted at all. Rows equal to ``last``
    in every displayed column are skipped with it.
    """
    direction = checked_direction(order_direction)
    df = filters.explorer(trips, **wanted)
    conditions, same = [], F.lit(True)
    for name in _order_names(df, order_by):
        column, value = F.col(name), F.lit(last[name])
        if last[name] is None:
            later = column.isNotNull() if direction == "asc" else F.lit(False)
        else:
            later = column > value if direction == "asc" else F.coalesce(column < value, F.lit(True))
        conditions.append(same & later)
        same = same & column.eqNullSafe(value)
    following = df.where(reduce(Column.__or__, conditions))
    order = _order(df, order_by, direction)
    names = list(dict.fromkeys(PAGE_COLUMNS + _order_names(df, order_by)))
    return following.select(*names).orderBy(*order).limit(page_size).select(*PAGE_COLUMNS)


def page_info(trips: DataFrame, page: int = 1, page_size: int = 100, **wanted) -> DataFrame:
    """One row about a page: size of the filtered set, pages, neighbours."""
    total = filters.explorer(trips, **wanted).agg(F.count(F.lit(1)).alias("total_count"))
    return info(total, page, page_size)


def info(total: DataFrame, page: int, page_size: int) -> DataFrame:
    """The row of ``page_info``, given the ``total_count``."""
    pages = F.ceil(F.col("total_count") / F.lit(page_size))
    return total.select(
        F.lit(page).alias("page"),
        F.lit(page_size).alias("page_size"),
        "total_count",
        pages.alias("total_pages"),
        (F.lit(page) < pages).alias("has_next"),
        F.lit(page > 1).alias("has_previous"),
    )
