"""What cleaning did to each load, noted while it was written and rolled up on read.

A row a load and month of pickup: trips in and out, failures per rule and non-finite
cells. The figures are sums by load and month, combined in every task before the shuffle,
in a scan of the columns they need. A load that is applied again replaces its rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from curbline.functions import columns as C
from curbline.functions.rollup import percent_of
from curbline.operators import clean
from curbline.plans.store import TripStore
from curbline.sources import storage

#: Keys (a load and month each) that a file of reports holds.
KEYS = 10_000
RULES = clean.RULES
FIGURES = ["input_rows", "output_rows", *[f"failed_{name}" for name in RULES], "non_finite_cells"]
SCHEMA = "load_id string, year int, month int, " + "".join(f"{f} long, " for f in FIGURES) + "nth long"


def figures(raw: DataFrame) -> DataFrame:
    """(load_id, year, month, ``FIGURES``) of raw trips; the month is that of pickup."""
    timed = clean.with_duration(raw)
    met = {name: F.coalesce(rule, F.lit(False)) for name, rule in clean.rules().items()}
    flags = {f"met_{name}": met[name] for name in RULES}
    month = {"year": F.year(C.PICKUP), "month": F.month(C.PICKUP)}
    rows = timed.select("load_id", *[c.alias(n) for n, c in {**month, **flags}.items()], clean.odd_cells(raw).alias("odd"))
    kept = reduce(Column.__and__, [F.col(f) for f in flags])
    sums = [F.count(F.lit(1)), F.count_if(kept), *[F.count_if(~F.col(f)) for f in flags], F.sum("odd")]
    return rows.groupBy("load_id", "year", "month").agg(*[s.alias(f) for s, f in zip(sums, FIGURES, strict=True)])


def note(spark: SparkSession, store: TripStore, told: list[Row], load_ids) -> None:
    """Add the reports of loads (rows of ``figures``); those without a trip get a row of zeros."""
    nth = 0
    if storage.exists(spark, store.reports_path):
        nth = _stored(spark, store).agg(F.coalesce(F.max("nth") + 1, F.lit(0))).first()[0]
    silent = sorted(set(load_ids) - {r["load_id"] for r in told})
    rows = [*map(tuple, told), *[(load, None, None, *[0] * len(FIGURES)) for load in silent]]
    noted = spark.createDataFrame(rows, SCHEMA.removesuffix(", nth long")).withColumn("nth", F.lit(nth).cast("long"))
    noted.coalesce(1).write.mode("append").option("maxRecordsPerFile", KEYS).parquet(store.reports_path)


def _stored(spark: SparkSession, store: TripStore) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(store.reports_path)


def load_reports(spark: SparkSession, store: TripStore) -> DataFrame:
    """The last report of every load, a row a month of pickup (NULL: no pickup time)."""
    if not storage.exists(spark, store.reports_path):
        return spark.createDataFrame([], SCHEMA).drop("nth")
    last = F.max("nth").over(Window.partitionBy("load_id"))
    return _stored(spark, store).withColumn("last", last).where("nth = last").drop("nth", "last")


def cleaning_report(spark: SparkSession, store: TripStore) -> DataFrame:
    """``clean.clean_report`` of all loads of a store, from their reports."""
    summed = load_reports(spark, store).agg(*[F.coalesce(F.sum(f), F.lit(0)).alias(f) for f in FIGURES])
    dropped = F.col("input_rows") - F.col("output_rows")
    shown = [dropped.alias("dropped_rows"), percent_of(dropped, F.col("input_rows")).alias("dropped_percent")]
    return summed.select(*FIGURES[:2], *shown, *FIGURES[2:])


def rows_per_month(spark: SparkSession, store: TripStore) -> DataFrame:
    """``sources.trips.load_report`` of the cleaned trips of a store, from its reports."""
    months = load_reports(spark, store).where("output_rows > 0").groupBy("year", "month")
    counted_rows = months.agg(F.sum("output_rows").alias("row_count"))
    total = F.sum("row_count").over(Window.partitionBy())
    return counted_rows.withColumn("total_rows", total).orderBy("year", "month")
