"""Which version of each file a store holds.

Every load adds a row a file: its load, path, length and time of modification. A file
whose length or time differs from its last row has been corrected since. Rows are
written after the load is complete, so a load that dies is due again; they state what
was listed before the file was read, so a file that changes meanwhile is due again too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.plans.store import TripStore
from curbline.sources import storage

SCHEMA = "load_id string, path string, length long, modified long, nth long"
VERSION = ["length", "modified"]


def taken(spark: SparkSession, store: TripStore) -> DataFrame:
    """(load_id, path, length, modified) of the last load of each file."""
    if not storage.exists(spark, store.ledger_path):
        return spark.createDataFrame([], SCHEMA).drop("nth")
    rows = spark.read.schema(SCHEMA).parquet(store.ledger_path)
    last = F.max_by(F.struct("path", *VERSION), "nth").alias("last")
    return rows.groupBy("load_id").agg(last).select("load_id", "last.*")


def note(spark: SparkSession, store: TripStore, files: DataFrame) -> None:
    """Add a load's files (load_id, path, length, modified)."""
    nth = 0
    if storage.exists(spark, store.ledger_path):
        rows = spark.read.schema(SCHEMA).parquet(store.ledger_path)
        nth = rows.agg(F.coalesce(F.max("nth") + 1, F.lit(0))).first()[0]
    numbered = files.select("load_id", "path", *VERSION, F.lit(nth).cast("long").alias("nth"))
    numbered.write.mode("append").parquet(store.ledger_path)


def due(spark: SparkSession, store: TripStore, files: DataFrame) -> DataFrame:
    """Files the store has not taken in this version."""
    return files.join(taken(spark, store), ["load_id", *VERSION], "left_anti")


def corrected(spark: SparkSession, store: TripStore, files: DataFrame) -> DataFrame:
    """Files the store has taken in another version."""
    known = taken(spark, store).select("load_id")
    return due(spark, store, files).join(known, "load_id", "left_semi")
