"""Where a dataset lives: cleaned trips and aggregate state below one root."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from curbline.plans import state
from curbline.plans import tables as T
from curbline.schema import CLEANED_SCHEMA
from curbline.sources import storage
from curbline.sources import trips as source


@dataclass(frozen=True)
class TripStore:
    root: str

    @property
    def cleaned_path(self) -> str:
        return f"{self.root.rstrip('/')}/cleaned"

    @property
    def ledger_path(self) -> str:
        return f"{self.root.rstrip('/')}/ledger"

    @property
    def reports_path(self) -> str:
        return f"{self.root.rstrip('/')}/reports"

    def state_path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/state/{name}"

    def cleaned(self, spark: SparkSession, months=None) -> DataFrame:
        """Cleaned trips; with ``months`` ((year, month) pairs) only their folders are
        listed and read."""
        if months is None:
            return source.read_cleaned(spark, self.cleaned_path)
        folders = [storage.partition_folder(spark, self.cleaned_path, year=y, month=m) for y, m in months]
        folders = [f for f in folders if storage.exists(spark, f)]
        if not folders:
            return spark.createDataFrame([], CLEANED_SCHEMA)
        return source.read_cleaned(spark, self.cleaned_path, folders)

    def state(self, spark: SparkSession, name: str) -> DataFrame:
        """Stored state. Its schema is that of its builder, so a state that holds no
        row yet (no airport trip, say) can be read too.

        The hourly, zone, route and airport states are the tables of the same kind
        plus ``year`` and ``month``, on which filters prune folders; give these to
        the query operators.
        """
        empty = spark.createDataFrame([], CLEANED_SCHEMA)
        return spark.read.schema(state.STATES[name](empty).schema).parquet(self.state_path(name))

    def table(self, spark: SparkSession, name: str, route_min_trips: int = T.MIN_ROUTE_TRIPS) -> DataFrame:
        """One of the seven aggregate tables, rolled up from the state it needs."""
        return state.FINAL_TABLES[name](lambda s: self.state(spark, s), route_min_trips)

    def tables(self, spark: SparkSession, route_min_trips: int = T.MIN_ROUTE_TRIPS) -> dict[str, DataFrame]:
        return {name: self.table(spark, name, route_min_trips) for name in state.FINAL_TABLES}
