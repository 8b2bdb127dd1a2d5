"""What keeps the disk a load takes in proportion to its trips."""

import time

import pytest
from pyspark.sql import functions as F

from conftest import rows, trip
from curbline import session
from curbline.plans import incremental
from curbline.plans.store import TripStore
from curbline.sources import storage
from curbline.sources import trips as source
from driver_tables import registry


def shuffle_files(spark) -> int:
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return len([f for f in disk.getAllFiles().mkString("|").split("|") if "/shuffle_" in f])


def test_a_load_leaves_no_shuffle_files(spark, raw, tmp_path):
    trips = raw([trip(passenger_count=1 + n % 6, VendorID=1 + n % 2) for n in range(60)]).repartition(4)
    source.export_csv(trips.localCheckpoint(), str(tmp_path / "drop"))
    store = TripStore(str(tmp_path / "store"))
    before = shuffle_files(spark)
    incremental.apply_load(spark, store, source.scan_csv(spark, str(tmp_path / "drop")))
    for _ in range(50):  # they are removed in the background
        if shuffle_files(spark) <= before:
            break
        time.sleep(0.2)
    assert shuffle_files(spark) <= before
    assert store.cleaned(spark).count() == 60
    assert spark.conf.get(session.SHUFFLE_CLEANUP) == "false"


def test_the_setting_is_put_back_after_a_failure(spark):
    other = spark.newSession()
    other.conf.set(session.SHUFFLE_CLEANUP, "true")
    with pytest.raises(ZeroDivisionError), session.shuffles_dropped(spark, other, spark):
        assert spark.conf.get(session.SHUFFLE_CLEANUP) == "true"
        1 / 0
    assert (spark.conf.get(session.SHUFFLE_CLEANUP), other.conf.get(session.SHUFFLE_CLEANUP)) == ("false", "true")


def test_a_delivery_is_not_held_beside_the_one_before(spark, raw, tmp_path, monkeypatch):
    first = raw([trip(passenger_count=n) for n in range(1, 41)]).repartition(6).localCheckpoint()
    second = first.withColumn("tip_amount", F.col("tip_amount") + 1)
    folder, write, kept = str(tmp_path / "drop"), source.export_csv, []

    def export(df, path):
        kept.append(storage.matching(spark, f"{folder}/*.csv"))
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
        write(df, path)

    monkeypatch.setattr(registry.source, "export_csv", export)
    names = []
    for delivered in (first, second):
        registry._deliver(spark, delivered, folder)
        names.append([p.rsplit("/", 1)[1] for p in storage.matching(spark, f"{folder}/*.csv")])
        tips = source.read_csv(spark, folder).select("passenger_count", "tip_amount")
        assert sorted(rows(tips)) == sorted(rows(delivered.select("passenger_count", "tip_amount")))
    assert kept == [[], []] and names[0] == names[1] and len(names[0]) == 6
