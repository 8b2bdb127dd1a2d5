"""What keeps loads and models in proportion to their input."""

import threading
from itertools import product

from conftest import rows, trip
from pyspark.sql import functions as F

from curbline.operators import clean, models, ranks, sampling
from curbline.plans import reports
from curbline.plans.state import MONTH
from curbline.sources import storage
from curbline.sources import trips as source
from driver_tables import registry


def test_a_report_is_one_row_a_load_and_month(raw):
    """However many kinds of trips there are: all 32 ways of breaking five rules."""
    bad = [("trip_distance", 500.0), ("fare_amount", 1.0), ("passenger_count", 9), ("pickup_latitude", 0.0), ("dropoff_latitude", float("nan"))]
    trips = raw([trip(**{k: v for (k, v), wrong in zip(bad, kind) if wrong}) for kind in product((False, True), repeat=5)])
    told = reports.figures(trips.withColumn("load_id", F.lit("a"))).collect()
    assert len(told) == 1
    report = clean.clean_report(trips).first()
    assert {f: told[0][f] for f in reports.FIGURES} == {f: report[f] for f in reports.FIGURES}


def test_value_ranges_take_no_array_per_trip(small_trips):
    plan = ranks.counts(small_trips, MONTH)._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" in plan and "Generate" not in plan
    # one copy of the formula, not one a column
    assert plan.lower().count("log10") == 1


def test_rows_of_a_fit_are_dealt_over_enough_tasks(spark, small_trips, monkeypatch):
    learned = models.learning_rows(small_trips).where("NOT is_test").coalesce(1)
    count = learned.count()
    monkeypatch.setattr(models, "ROWS_PER_TASK", {"gbt": count // 5})
    assert models.tasks_for(learned, "gbt", count) >= 5
    assert models.tasks_for(learned, "gbt", count // 5) is None
    assert models.tasks_for(learned, "linear_regression", count) is None
    dealt = []
    monkeypatch.setattr(models, "spread", lambda df, n: dealt.append(n) or df.repartition(n))
    models.train(small_trips, "gbt", maxIter=1)
    assert dealt[0] >= 5


def test_boosted_trees_store_no_node_ids():
    assert not models._regressor("gbt").getCacheNodeIds()
    assert models._regressor("random_forest").getCacheNodeIds()


def test_large_deliveries_have_more_files(spark, raw, tmp_path):
    made = raw([trip(passenger_count=n) for n in range(1, 60)]).repartition(9)
    registry._deliver(spark, made, str(tmp_path))
    names = {p.rsplit("/", 1)[1] for p in storage.matching(spark, f"{tmp_path}/*.csv")}
    assert 4 < len(names) <= 9
    read = spark.read.option("header", True).csv(str(tmp_path)).select("passenger_count")
    assert sorted(int(v) for (v,) in rows(read)) == list(range(1, 60))


def test_load_ids_are_worked_out_once_a_file(spark, raw, tmp_path):
    """Every row looks its file up; names with blanks and signs are found, and a file that
    is named twice is read twice, not four times."""
    for name in ("a b%20c,1.csv", "é+[x].csv"):
        source.export_csv(raw([trip(), trip(VendorID=2)]).coalesce(1), str(tmp_path / "made"))
        storage.move_file(spark, storage.matching(spark, f"{tmp_path}/made/part-*.csv")[0], f"{tmp_path}/drop/{name}")
    one = storage.literal(f"{tmp_path}/drop/a b%20c,1.csv")
    for path, root in ((f"{tmp_path}/drop", None), (f"{tmp_path}/drop", str(tmp_path)), ([one, one], None)):
        by_row = source.with_load_id(source.read_csv(spark, path), root)
        scanned = source.scan_csv(spark, path, root)
        plan = scanned._jdf.queryExecution().optimizedPlan().toString()
        assert "Join LeftOuter" in plan and "strategy=broadcast" in plan
        assert scanned.columns == by_row.columns
        assert sorted(rows(scanned)) == sorted(rows(by_row)) and scanned.count() == 4
        listed = {r["load_id"] for r in source.csv_files(spark, path, root).collect()}
        assert {r["load_id"] for r in scanned.collect()} == listed


def test_a_file_after_the_listing_keeps_its_load(spark, raw, tmp_path):
    source.export_csv(raw([trip()]), str(tmp_path / "drop"))
    source.export_csv(raw([trip(VendorID=2)]), str(tmp_path / "other"))
    late = source.read_csv(spark, [str(tmp_path / "drop"), str(tmp_path / "other")])
    named = source.with_listed_load_id(late, str(tmp_path / "drop"))
    assert sorted(rows(named)) == sorted(rows(source.with_load_id(late)))


def test_sides_of_the_split_are_those_of_its_slots(spark):
    numbers = spark.range(3000).withColumn("none", F.lit(None).cast("int"))
    for seed in (sampling.SEED, 7):
        slot = sampling.split_slot(["id", "none"], seed) >= round(sampling.TRAIN_SHARE * 65536)
        assert numbers.where(slot != sampling.on_test_side(["id", "none"], seed)).count() == 0


def test_few_rows_are_fitted_by_all_kinds_together(small_trips, monkeypatch):
    barrier = threading.Barrier(3)

    def fit(rows, name, counts, partitions, **params):
        barrier.wait(60)
        return models.FareModel(name, None)

    monkeypatch.setattr(models, "fit_one", fit)
    trained = models.train_all(small_trips)
    assert list(trained) == list(models.MODEL_FOLDERS) and not any(m.error for m in trained.values())
    running, most = [], []

    def alone(rows, name, counts, partitions, **params):
        running.append(name)
        most.append(len(running))
        running.remove(name)
        return models.FareModel(name, None)

    monkeypatch.setattr(models, "fit_one", alone)
    monkeypatch.setattr(models, "ROWS_TOGETHER", 0)
    assert list(models.train_all(small_trips)) == list(models.MODEL_FOLDERS) and max(most) == 1
