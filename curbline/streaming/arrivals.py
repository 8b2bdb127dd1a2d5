"""Monthly files taken up as they arrive."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from curbline.plans.incremental import apply_load, load_corrected, load_listed
from curbline.plans.store import TripStore
from curbline.sources import storage
from curbline.sources import trips as source


@contextmanager
def _adaptive(session: SparkSession):
    """Adaptive execution for the batch writes inside a micro-batch.

    A stream's session runs without it, and only with it is a hot month split
    over several writers.
    """
    before = session.conf.get("spark.sql.adaptive.enabled")
    session.conf.set("spark.sql.adaptive.enabled", "true")
    try:
        yield
    finally:
        session.conf.set("spark.sql.adaptive.enabled", before)


def store_arrivals(
    spark: SparkSession,
    folder: str,
    store: TripStore,
    checkpoint: str,
    files_per_batch: int | None = None,
    repair: bool = False,
) -> StreamingQuery:
    """Take up every new and every corrected ``*.csv`` of a folder into the store, then stop.

    The checkpoint remembers the paths already taken, the store's ledger the versions:
    a file that changed under a known path, which the file source does not look at
    again, is loaded before the stream starts. The stream lists files; a micro-batch
    loads its files and notes them, files without a row too. One that is replayed after
    a failure replaces the same partitions, so it adds nothing twice.
    """
    if storage.matching(spark, f"{storage.literal(folder.rstrip('/'))}/*.csv"):
        load_corrected(spark, store, f"{storage.literal(folder.rstrip('/'))}/*.csv", repair)

    def take_up(files: DataFrame, _batch_id: int) -> None:
        with _adaptive(files.sparkSession):
            load_listed(files.sparkSession, store, files, repair=repair)

    return _available_now(source.stream_files(spark, folder, files_per_batch), take_up, checkpoint)


def store_stream(spark: SparkSession, trips: DataFrame, store: TripStore, checkpoint: str) -> StreamingQuery:
    """Same for any stream of raw trips with a ``load_id`` column.

    A load must arrive whole within one micro-batch, as files do.
    """

    def take_up(batch: DataFrame, _batch_id: int) -> None:
        with _adaptive(batch.sparkSession):
            apply_load(spark, store, batch)

    return _available_now(trips, take_up, checkpoint)


def _available_now(stream: DataFrame, take_up, checkpoint: str) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(take_up)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
