"""Adding, or re-adding, monthly files without recomputing the rest.

Cleaned trips are partitioned by (year, month, load_id), the load being the file
a row came from (told apart by its whole path). A load replaces its own partitions and no others, so running it
again changes nothing, a corrected file takes the place of its first version, and
a stray row of an old month is added to that month. The state of every touched
month is then rebuilt from all loads of that month.

Steps are ordered so that a job that dies can simply be run again: partitions a
corrected file no longer fills are left out while the state is rebuilt and
removed last.
"""

from __future__ import annotations

import json
import re
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from curbline.plans import ledger, reports, state
from curbline.plans.store import TripStore
from curbline.session import shuffles_dropped
from curbline.sources import storage
from curbline.sources import trips as source

TOUCHED_SCHEMA = StructType([StructField("year", IntegerType()), StructField("month", IntegerType())])


def load_csv(
    spark: SparkSession, store: TripStore, csv_path, drop_root: str | None = None, repair: bool = False
) -> DataFrame:
    """Clean CSV files into the store and refresh the months they touch.

    A file takes the place of an earlier one of the same path (from ``drop_root`` on,
    if given), never of one that only has the same name. ``repair`` reads badly typed
    cells in other ways before they count as missing. Returns the touched (year, month)
    pairs.
    """
    return load_listed(spark, store, source.csv_files(spark, csv_path, drop_root), drop_root, repair)


def load_changed(
    spark: SparkSession, store: TripStore, csv_path, drop_root: str | None = None, repair: bool = False
) -> DataFrame:
    """``load_csv`` of those files that are new or were corrected since their last load.

    Files that left the folder keep their trips.
    """
    files = ledger.due(spark, store, source.csv_files(spark, csv_path, drop_root))
    return load_listed(spark, store, files, drop_root, repair)


def load_corrected(spark: SparkSession, store: TripStore, csv_path, repair: bool = False) -> DataFrame:
    """``load_csv`` of those files that the store holds in another version."""
    files = ledger.corrected(spark, store, source.csv_files(spark, csv_path))
    return load_listed(spark, store, files, repair=repair)


def load_listed(
    spark: SparkSession, store: TripStore, files: DataFrame, drop_root: str | None = None, repair: bool = False
) -> DataFrame:
    """Load listed files (load_id, path, length, modified) and note them; the driver sees
    a row a file."""
    listed = files.collect()
    if not listed:
        return spark.createDataFrame([], TOUCHED_SCHEMA)
    raw = source.scan_csv(spark, [storage.literal(f["path"]) for f in listed], drop_root, repair)
    touched = apply_load(spark, store, raw, [f["load_id"] for f in listed])
    ledger.note(spark, store, spark.createDataFrame(listed, files.schema))
    return touched


def apply_load(spark: SparkSession, store: TripStore, raw: DataFrame, load_ids=()) -> DataFrame:
    """Put raw trips with a ``load_id`` into the store; returns touched months.

    ``load_ids`` names loads that may hold no row at all. The driver sees the
    partitions written (months times files), never rows.
    """
    with shuffles_dropped(spark, raw.sparkSession):
        return _applied(spark, store, raw, load_ids)


def _applied(spark: SparkSession, store: TripStore, raw: DataFrame, load_ids) -> DataFrame:
    written, seen, told = _write_loads(store, raw)
    stale = _stale_partitions(spark, store, set(load_ids) | seen, written)
    months = sorted({(y, m) for y, m, _ in written | stale})
    refresh(spark, store, months, without=stale)
    for y, m, load in stale:
        storage.drop_folder(
            spark, storage.partition_folder(spark, store.cleaned_path, year=y, month=m, load_id=load)
        )
    reports.note(spark, store, told, set(load_ids) | seen)
    return spark.createDataFrame(months, TOUCHED_SCHEMA)


def _as_json_set(*columns: str) -> Column:
    return F.to_json(F.collect_set(F.struct(*columns)))


def _noted(observation: Observation) -> list | None:
    """What ``_as_json_set`` saw; None if the observed step turned out empty and
    adaptive execution dropped it together with its notes."""
    row = observation._jo.getRow()
    return json.loads(row.getString(0)) if row.length() else None


def _write_loads(store: TripStore, raw: DataFrame) -> tuple[set, set, list]:
    """Write the cleaned rows; returns which partitions they fell into, the loads seen, and
    what cleaning did to each load and month.

    A trip needs one of these figures or more, so they are summed by a grouped pass of its
    own over the columns of the rules: noting keys in the pass that writes took longer.
    """
    told = reports.figures(raw).collect()
    if any(r["load_id"] is None for r in told):
        raise ValueError("raw trips need a load_id")
    source.write_partitioned(source.cleaned_rows(raw), store.cleaned_path, source.LOAD_PARTITIONS, dynamic=True)
    written = {(r["year"], r["month"], r["load_id"]) for r in told if r["output_rows"]}
    return written, {r["load_id"] for r in told}, told


def _stale_partitions(spark: SparkSession, store: TripStore, load_ids: set, written: set) -> set:
    """Partitions of these loads that an earlier run filled and this one did not."""
    held = set()
    for load in sorted(load_ids):
        pattern = f"{store.cleaned_path}/year=*/month=*/load_id={storage.literal(storage.escaped(spark, load))}"
        for folder in storage.matching(spark, pattern):
            year, month = re.search(r"/year=(-?\d+)/month=(\d+)/load_id=[^/]*$", folder).groups()
            held.add((int(year), int(month), load))
    return held - written


def _partition_in(partitions) -> Column:
    named = F.concat_ws("/", *[F.col(c).cast("string") for c in source.LOAD_PARTITIONS])
    return named.isin(*[f"{y}/{m}/{load}" for y, m, load in partitions])


def refresh(spark: SparkSession, store: TripStore, months, without=()) -> None:
    """Rebuild the state of some months from the cleaned trips.

    Only the folders of those months are read and written, and each state scans
    only the columns it needs.
    """
    months = list(months)
    if not months:
        return
    trips = store.cleaned(spark, months)
    if without:
        trips = trips.where(~_partition_in(without))

    def rebuild(name: str) -> None:
        filled = Observation()
        rows = state.STATES[name](trips).observe(filled, _as_json_set(*state.MONTH).alias("seen"))
        source.write_partitioned(rows, store.state_path(name), state.MONTH, dynamic=True)
        kept = {(p["year"], p["month"]) for p in _noted(filled) or []}
        for y, m in set(months) - kept:
            storage.drop_folder(spark, storage.partition_folder(spark, store.state_path(name), year=y, month=m))

    _for_each_state(rebuild)


def rebuild_all(spark: SparkSession, store: TripStore) -> None:
    """State of every month in the store, in one pass per table."""
    trips = store.cleaned(spark)
    _for_each_state(
        lambda name: source.write_partitioned(state.STATES[name](trips), store.state_path(name), state.MONTH)
    )


def _for_each_state(work) -> None:
    """The states do not depend on each other, and the small ones leave most of a
    cluster idle, so a few are written at the same time."""
    with ThreadPoolExecutor(max_workers=4) as pool:
        for done in [pool.submit(work, name) for name in state.STATES]:
            done.result()
