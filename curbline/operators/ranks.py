"""Rows per value range of the columns that pages are ordered by, as mergeable counts.

Ranges are fixed beforehand, so that counts of months and loads add up: hours for times,
and for numbers all values that share a sign, a power of ten and three leading digits. A
column has some 900 ranges for each power of ten its values span, whatever the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from curbline.functions import columns as C
from curbline.operators.explore import PAGE_COLUMNS

TIMES = [C.PICKUP, C.DROPOFF]
# ranges of one power of ten, powers below 1 that doubles have, and places past them
_DIGITS, _POWERS, _INFINITE = 2000, 400, 2_000_000


def _power(v: Column) -> Column:
    return F.floor(F.log10(F.abs(v)))


def _number_range(v: Column, power: Column | None = None) -> Column:
    """Whole number that grows with ``v``: no step of it can turn the order of two values.
    ``power`` names a column that holds ``_power`` of it already."""
    size = F.abs(v)
    power = _power(v) if power is None else power
    digits = F.least(F.floor(size / F.pow(F.lit(10.0), F.greatest(power - 2, F.lit(-305)))), F.lit(_DIGITS - 1))
    place = (power + _POWERS) * _DIGITS + digits
    return (
        F.when(v.isNull(), F.lit(None))
        .when(F.isnan(v), F.lit(_INFINITE + 1))
        .when(size == float("inf"), F.signum(v) * _INFINITE)
        .when(size == 0, F.lit(0))
        .otherwise(F.signum(v) * place)
        .cast("long")
    )


def counts(trips: DataFrame, months: list[str]) -> DataFrame:
    """(months, column, range, n, low, high, first, last): rows of each range, with its
    least and greatest number or time. NULL cells have the range NULL."""
    cells, named = [], []
    for i, name in enumerate(PAGE_COLUMNS):
        time = F.col(name) if name in TIMES else F.lit(None).cast("timestamp")
        number = F.lit(None).cast("double") if name in TIMES else F.col(name).cast("double")
        cells += [number.alias(f"v{i}"), time.alias(f"t{i}")]
        named.append(f"(v{i}, t{i}) AS `{name}`")
    # cells become rows by a projection each, then one copy of the formula gives their
    # ranges: ten copies side by side make code too long for Java to compile
    long = trips.sparkSession.sql(
        f"SELECT * FROM {{cells}} UNPIVOT INCLUDE NULLS ((number, time) FOR `column` IN ({', '.join(named)}))",
        cells=trips.select(*months, *cells),
    ).withColumn("power", _power(F.col("number")))
    hour = F.floor(F.unix_seconds("time") / 3600)
    place = F.when(F.col("time").isNotNull(), hour).otherwise(_number_range(F.col("number"), F.col("power")))
    long = long.select(*months, "column", place.alias("range"), "number", "time")
    return long.groupBy(*months, "column", "range").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("number").alias("low"),
        F.max("number").alias("high"),
        F.min("time").alias("first"),
        F.max("time").alias("last"),
    )


def span(counted: DataFrame, months: list[str], name: str, direction: str, offset: int, size: int) -> Row | None:
    """The ranges that hold the rows from ``offset`` on, ``size`` of them, in the order of
    one column (NULL first when ascending, last when descending).

    Returns the rows ``before`` them, their bounds, whether NULL cells are among them, and
    their ``months``; None past the end. The window sees one row a range.
    """
    ranges = counted.where(F.col("column") == name).groupBy("range").agg(
        F.sum("n").alias("n"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.collect_set(F.struct(*months)).alias("months"),
    )
    place = F.col("range")
    order = place.asc_nulls_first() if direction == "asc" else place.desc_nulls_last()
    upto = F.sum("n").over(Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    reached = ranges.withColumn("upto", upto).where((F.col("upto") > offset) & (F.col("upto") - F.col("n") < offset + size))
    found = reached.agg(
        F.min(F.col("upto") - F.col("n")).alias("before"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.coalesce(F.bool_or(place.isNull()), F.lit(False)).alias("nulls"),
        F.array_distinct(F.flatten(F.collect_list("months"))).alias("months"),
    ).first()
    return None if found["before"] is None else found


def within(found: Row, name: str) -> Column:
    """Test of a row of trips: its cell lies in the ranges of ``span``.

    NaN is tested for by name, as statistics of files know no order for it.
    """
    low, high = (found["first"], found["last"]) if name in TIMES else (found["low"], found["high"])
    cell = F.col(name)
    if low is None:
        inside = F.lit(False)
    elif high != high:
        inside = F.isnan(name) if low != low else (cell >= F.lit(low)) | F.isnan(name)
    else:
        inside = cell.between(F.lit(low), F.lit(high))
    return inside | cell.isNull() if found["nulls"] else inside
