"""Pages of a store's trips, found from stored counts in place of scans.

The ``ranks`` state counts trips per month and value range of every displayed column.
A page reads the months and the range it lies in, and no other file, however far in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.functions import columns as C
from curbline.operators import explore, ranks
from curbline.plans.state import MONTH
from curbline.plans.store import TripStore


def _counts(spark: SparkSession, store: TripStore, year, month) -> DataFrame:
    counted = store.state(spark, "ranks")
    for name, wanted in (("year", year), ("month", month)):
        if wanted is not None:
            counted = counted.where(F.col(name) == int(wanted))
    return counted


def page(
    spark: SparkSession,
    store: TripStore,
    page: int = 1,
    page_size: int = 100,
    order_by: str | None = None,
    order_direction: str = "asc",
    year=None,
    month=None,
    rest_rows: int = explore.REST_ROWS,
) -> DataFrame:
    """``explore.explore`` of the cleaned trips of a store, all or of a year or month.

    One small job over the counts finds the ranges that hold the page. Where these hold
    more than ``rest_rows`` rows before it, they alone are counted further. Columns
    that are not displayed have no counts: pages ordered by them are found by scans.
    """
    offset = explore.page_offset(page, page_size)
    direction = explore.checked_direction(order_direction)
    cleaned = store.cleaned(spark)
    name = order_by if order_by in cleaned.columns else C.PICKUP
    if name not in explore.PAGE_COLUMNS:
        return explore.explore(cleaned, page, page_size, name, direction, rest_rows, year=year, month=month)
    found = ranks.span(_counts(spark, store, year, month), MONTH, name, direction, offset, page_size)
    if found is None:
        return cleaned.select(*explore.PAGE_COLUMNS).limit(0)
    trips = store.cleaned(spark, [tuple(m) for m in found["months"]]).where(ranks.within(found, name))
    return explore.rows_from(trips, offset - found["before"], page_size, name, direction, rest_rows)


def page_info(spark: SparkSession, store: TripStore, page: int = 1, page_size: int = 100, year=None, month=None) -> DataFrame:
    """``explore.page_info`` of the cleaned trips of a store, without reading a trip."""
    counted = _counts(spark, store, year, month).where(F.col("column") == C.PICKUP)
    return explore.info(counted.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_count")), page, page_size)
