"""CSV drops, incremental loads, streaming: every route to the same tables."""

from datetime import datetime, timedelta

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from conftest import rows, trip
from curbline.operators import clean, economic
from curbline.plans import batch, incremental, ledger, reports, state
from curbline.plans import tables as T
from curbline.plans.store import TripStore
from curbline.schema import TRIP_SCHEMA
from curbline.sources import cells
from curbline.sources import trips as source
from curbline.streaming import arrivals


def monthly(year, month, n, first_day=1, **changes):
    out = []
    for i in range(n):
        start = datetime(year, month, first_day + i % 20, (7 * i) % 24, i % 60)
        out.append(
            trip(
                tpep_pickup_datetime=start,
                tpep_dropoff_datetime=start + timedelta(minutes=5 + i % 50),
                trip_distance=0.5 + (i * 37 % 140) / 10,
                fare_amount=5.0 + (i * 13 % 40) + 0.25 * (i % 4),
                tip_amount=None if i % 11 == 0 else round((i * 7 % 9) * 0.5, 2),
                passenger_count=1 + i % 7,
                payment_type=1 + i % 2,
                total_amount=20.0 + i % 5,
                **changes,
            )
        )
    return out


DROPS = {
    "2015-01.csv": monthly(2015, 1, 60),
    "2015-02.csv": monthly(2015, 2, 50),
    # a later file with three stray rows of an old month
    "2016-01.csv": monthly(2016, 1, 40) + monthly(2015, 1, 3, first_day=25),
}


def write_csv(path, rows_):
    def text(v):
        return "" if v is None else str(v)

    lines = [",".join(TRIP_SCHEMA.names)]
    lines += [",".join(text(r[f]) for f in TRIP_SCHEMA.names) for r in rows_]
    path.write_text("\n".join(lines) + "\n")
    return str(path)


@pytest.fixture(scope="module")
def drops(tmp_path_factory):
    folder = tmp_path_factory.mktemp("drops")
    for name, data in DROPS.items():
        write_csv(folder / name, data)
    return folder


def close(a, b):
    a, b = sorted(a, key=str), sorted(b, key=str)
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert [v for v in x if not isinstance(v, float)] == [v for v in y if not isinstance(v, float)]
        assert [v for v in x if isinstance(v, float)] == pytest.approx([v for v in y if isinstance(v, float)])


def assert_tables_equal_direct(spark, store, raw_rows):
    """Every stored table equals the one built directly from these raw trips."""
    from conftest import TRIP_SCHEMA as schema

    raw = spark.createDataFrame([tuple(r[f] for f in schema.names) for r in raw_rows], schema)
    trips = clean.clean_trips(raw)
    stored = store.tables(spark, route_min_trips=2)
    for name, build in T.BUILDERS.items():
        direct = build(trips, min_trips=2) if name == "route_pairs_top" else build(trips)
        close(rows(stored[name].select(direct.columns)), rows(direct))


def everything(*names):
    return [r for n in names for r in DROPS[n]]


def test_csv_cells(spark, tmp_path):
    header = ",".join(TRIP_SCHEMA.names)
    ordinary = ",".join(str(trip()[f]) for f in TRIP_SCHEMA.names)
    odd = ordinary.split(",")
    odd[3], odd[1], odd[15] = "1.0", "2015-13-01 00:00:00", ""
    path = tmp_path / "bad.csv"
    path.write_text("\n".join([header, ordinary, ",".join(odd), "2,2015-01-05 10:00:00"]) + "\n")
    good, bad, short = source.read_csv(spark, str(path)).collect()
    assert good["passenger_count"] == 1 and good["fare_amount"] == 12.0
    assert (bad["passenger_count"], bad["tpep_pickup_datetime"], bad["tip_amount"]) == (None, None, None)
    assert bad["fare_amount"] == 12.0
    assert short["VendorID"] == 2 and short["fare_amount"] is None


ODD_CELLS = {
    "VendorID": ["2.0", " 2 ", "2.5", "two", ""],
    "passenger_count": ["1.0", "+1", "1e0", "99999999999", "  "],
    "fare_amount": ["$1,234.50", "-$3", "12,34", "1,234", "NaN"],
    "tpep_pickup_datetime": ["1/5/2015 10:00", "01/05/2015 10:00:00 pm", "2015-01-05T10:00:00", "10:00:00", "2015-02-30 00:00:00"],
}
READ_CELLS = {
    "VendorID": [2, 2, None, None, None],
    "passenger_count": [1, 1, 1, None, None],
    "fare_amount": [1234.5, -3.0, None, 1234.0, "nan"],
    "tpep_pickup_datetime": [datetime(2015, 1, 5, 10), datetime(2015, 1, 5, 22), datetime(2015, 1, 5, 10), None, None],
}
CELL_COUNTS = {  # empty, repaired, rejected
    "VendorID": (1, 1, 2),
    "passenger_count": (1, 2, 1),
    "fare_amount": (0, 3, 1),
    "tpep_pickup_datetime": (0, 2, 2),
    "trip_distance": (0, 0, 0),
}


def test_cells_are_repaired_or_rejected(spark):
    ordinary = {f: str(v) for f, v in trip().items()}
    texts = [{**ordinary, **{c: cells_[i] for c, cells_ in ODD_CELLS.items()}} for i in range(5)]
    frame = spark.createDataFrame([tuple(t[f] for f in TRIP_SCHEMA.names) for t in texts], cells.as_text()).coalesce(1)
    read = cells.typed(frame)
    assert read.schema == TRIP_SCHEMA
    got = read.collect()
    for name, want in READ_CELLS.items():
        shown = [r[name] if r[name] == r[name] else "nan" for r in got]
        assert shown == want, name
    counts = {r["column_name"]: (r["empty"], r["repaired"], r["rejected"]) for r in cells.cell_report(frame).collect()}
    assert {c: counts[c] for c in CELL_COUNTS} == CELL_COUNTS
    empty = cells.cell_report(frame.limit(0)).collect()
    assert len(empty) == len(TRIP_SCHEMA) and all(r["cells"] == r["rejected"] == 0 for r in empty)


def test_ordinary_files_read_alike_with_and_without_repair(spark, drops):
    assert sorted(rows(source.read_csv(spark, str(drops), repair=True)), key=str) == sorted(rows(source.read_csv(spark, str(drops))), key=str)


def test_a_file_of_odd_passengers_loads_whole(spark, tmp_path):
    path = write_csv(tmp_path / "odd.csv", [{**r, "passenger_count": f"{r['passenger_count']}.0"} for r in DROPS["2015-01.csv"]])
    strict, store = TripStore(str(tmp_path / "strict")), TripStore(str(tmp_path / "store"))
    assert incremental.load_csv(spark, strict, path).count() == 0
    incremental.load_csv(spark, store, path, repair=True)
    assert_tables_equal_direct(spark, store, DROPS["2015-01.csv"])


def test_changed_files_are_loaded_again_and_no_others(spark, tmp_path):
    folder, store = tmp_path / "drop [x] 1", TripStore(str(tmp_path / "store"))
    folder.mkdir()
    for name in ("2015-01.csv", "2015-02.csv"):
        write_csv(folder / name, DROPS[name])
    write_csv(folder / "empty.csv", [])
    pattern = str(folder).replace("[", "\\[").replace("]", "\\]")
    assert sorted(rows(incremental.load_changed(spark, store, pattern))) == [(2015, 1), (2015, 2)]
    assert incremental.load_changed(spark, store, pattern).count() == 0
    write_csv(folder / "2015-02.csv", DROPS["2015-02.csv"][:20])
    write_csv(folder / "empty.csv", DROPS["2016-01.csv"][:40])
    assert sorted(rows(incremental.load_changed(spark, store, pattern))) == [(2015, 2), (2016, 1)]
    assert_tables_equal_direct(
        spark, store, DROPS["2015-01.csv"] + DROPS["2015-02.csv"][:20] + DROPS["2016-01.csv"][:40]
    )
    assert ledger.taken(spark, store).count() == 3


def test_a_stream_takes_up_corrected_files(spark, tmp_path):
    folder, store, check = tmp_path / "drop", TripStore(str(tmp_path / "store")), str(tmp_path / "check")
    folder.mkdir()
    arrivals.store_arrivals(spark, str(folder), store, check).awaitTermination()  # nothing yet
    write_csv(folder / "2015-01.csv", DROPS["2015-01.csv"][:10])
    write_csv(folder / "2015-02.csv", [])
    arrivals.store_arrivals(spark, str(folder), store, check).awaitTermination()
    for name in DROPS:  # two corrected, one of them without a row before, and one new
        write_csv(folder / name, DROPS[name])
    arrivals.store_arrivals(spark, str(folder), store, check).awaitTermination()
    assert_tables_equal_direct(spark, store, everything(*DROPS))


@pytest.mark.parametrize("keys", [reports.KEYS, 3])
def test_reports_of_loads(spark, tmp_path, monkeypatch, keys):
    """Noted with the pass that writes, or by one of their own where keys are too many."""
    monkeypatch.setattr(reports, "KEYS", keys)
    store = TripStore(str(tmp_path / "store"))
    assert reports.cleaning_report(spark, store).first()["input_rows"] == 0
    odd = [trip(fare_amount=float("nan")), trip(tpep_pickup_datetime=None), trip(trip_distance=500.0, passenger_count=9)]
    a = write_csv(tmp_path / "a.csv", DROPS["2015-01.csv"] + odd)
    b = write_csv(tmp_path / "b.csv", DROPS["2016-01.csv"])
    rejects = write_csv(tmp_path / "rejects.csv", odd)
    for path in ([a, b], a, rejects):
        incremental.load_csv(spark, store, path)
    everything_raw = source.read_csv(spark, [a, b, rejects])
    assert rows(reports.cleaning_report(spark, store)) == rows(clean.clean_report(everything_raw))
    assert rows(reports.rows_per_month(spark, store)) == rows(source.load_report(store.cleaned(spark)))
    write_csv(tmp_path / "b.csv", [])
    incremental.load_changed(spark, store, [a, b, rejects])
    assert rows(reports.cleaning_report(spark, store)) == rows(clean.clean_report(source.read_csv(spark, [a, b, rejects])))


def test_folder_ingest_and_report(spark, drops, tmp_path):
    stored = source.ingest_folder(spark, str(drops), str(tmp_path / "raw"))
    assert rows(source.load_report(stored)) == [(2015, 1, 63, 153), (2015, 2, 50, 153), (2016, 1, 40, 153)]
    assert {r[0].split("~")[0] for r in stored.select("load_id").distinct().collect()} == set(DROPS)


def test_one_file_with_chosen_partitions(spark, drops, tmp_path):
    out = tmp_path / "one"
    source.ingest_csv(spark, str(drops / "2015-02.csv"), str(out), partition_by=["year"])
    assert [p.name for p in out.iterdir() if p.is_dir()] == ["year=2015"]


def test_folder_without_csv_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException):
        source.ingest_folder(spark, str(tmp_path), str(tmp_path / "out"))


@pytest.mark.parametrize("order", [list(DROPS), list(DROPS)[::-1]])
def test_loading_order_does_not_matter(spark, drops, tmp_path, order):
    store = TripStore(str(tmp_path / "store"))
    touched = [sorted(rows(incremental.load_csv(spark, store, str(drops / n)))) for n in order]
    assert touched[order.index("2016-01.csv")] == [(2015, 1), (2016, 1)]
    assert_tables_equal_direct(spark, store, everything(*DROPS))


def test_reload_correction_and_emptied_month(spark, drops, tmp_path):
    store = TripStore(str(tmp_path / "store"))

    def load(folder, *names):
        return incremental.load_csv(spark, store, [str(folder / n) for n in names], drop_root=str(folder))

    load(drops, *DROPS)
    before = (tmp_path / "store" / "state" / "fares" / "year=2015" / "month=2").stat().st_mtime_ns

    # the same file again changes nothing
    load(drops, "2016-01.csv")
    assert_tables_equal_direct(spark, store, everything(*DROPS))
    after = (tmp_path / "store" / "state" / "fares" / "year=2015" / "month=2").stat().st_mtime_ns
    assert before == after, "an untouched month was rewritten"

    # a corrected version without the stray rows takes them out of the old month
    fixed = tmp_path / "fixed"
    fixed.mkdir()
    write_csv(fixed / "2016-01.csv", DROPS["2016-01.csv"][:30])
    touched = load(fixed, "2016-01.csv")
    assert sorted(rows(touched)) == [(2015, 1), (2016, 1)]
    remaining = everything("2015-01.csv", "2015-02.csv") + DROPS["2016-01.csv"][:30]
    assert_tables_equal_direct(spark, store, remaining)

    # a correction that holds nothing usable removes the month altogether
    write_csv(fixed / "2015-02.csv", [trip(fare_amount=-1.0)])
    load(fixed, "2015-02.csv")
    assert_tables_equal_direct(spark, store, DROPS["2015-01.csv"] + DROPS["2016-01.csv"][:30])

    # odd file names are load names like any other
    write_csv(fixed / "a b=50%.csv", monthly(2016, 5, 9))
    load(fixed, "a b=50%.csv")
    write_csv(fixed / "a b=50%.csv", [])
    touched = load(fixed, "a b=50%.csv")
    assert rows(touched) == [(2016, 5)]

    # and so does one without any line
    write_csv(fixed / "2016-01.csv", [])
    load(fixed, "2016-01.csv")
    assert_tables_equal_direct(spark, store, DROPS["2015-01.csv"])


def test_interrupted_correction_can_be_repeated(spark, drops, tmp_path, monkeypatch):
    store = TripStore(str(tmp_path / "store"))
    incremental.load_csv(spark, store, [str(drops / n) for n in DROPS], drop_root=str(drops))
    fixed = tmp_path / "fixed"
    fixed.mkdir()
    path = write_csv(fixed / "2016-01.csv", DROPS["2016-01.csv"][:10])

    def die(*_, **__):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as broken:
        broken.setattr(incremental, "refresh", die)
        with pytest.raises(RuntimeError):
            incremental.load_csv(spark, store, path, drop_root=str(fixed))
    incremental.load_csv(spark, store, path, drop_root=str(fixed))
    assert_tables_equal_direct(spark, store, everything("2015-01.csv", "2015-02.csv") + DROPS["2016-01.csv"][:10])


def test_economic_answers_from_state(spark, drops, tmp_path):
    store = TripStore(str(tmp_path / "store"))
    incremental.load_csv(spark, store, [str(drops / n) for n in DROPS])
    trips, fares = store.cleaned(spark), store.state(spark, "fares")
    for group in ("payment_type", "hour", "distance_bucket"):
        close(rows(state.tip_analysis(fares, group)), rows(economic.tip_analysis(trips, group)))
    close(rows(state.revenue_by_hour(fares, 2015)), rows(economic.revenue_analysis(trips, "hour", 2015)))
    close(rows(state.price_elasticity(fares)), rows(economic.price_elasticity(trips)))
    close(rows(economic.tip_ratio(store.state(spark, "tips"))), rows(economic.tip_ratio(trips)))


def test_stream_equals_batch_and_replays_nothing(spark, drops, tmp_path):
    folder, store = tmp_path / "in", TripStore(str(tmp_path / "store"))
    folder.mkdir()
    check = str(tmp_path / "check")
    write_csv(folder / "2015-01.csv", DROPS["2015-01.csv"])
    write_csv(folder / "2015-02.csv", DROPS["2015-02.csv"])
    arrivals.store_arrivals(spark, str(folder), store, check, files_per_batch=1).awaitTermination()
    assert_tables_equal_direct(spark, store, everything("2015-01.csv", "2015-02.csv"))

    arrivals.store_arrivals(spark, str(folder), store, check).awaitTermination()
    assert_tables_equal_direct(spark, store, everything("2015-01.csv", "2015-02.csv"))

    write_csv(folder / "2016-01.csv", DROPS["2016-01.csv"])
    arrivals.store_arrivals(spark, str(folder), store, check).awaitTermination()
    assert_tables_equal_direct(spark, store, everything(*DROPS))

    # a stream that lost its checkpoint sees all files again
    arrivals.store_arrivals(spark, str(folder), store, str(tmp_path / "new")).awaitTermination()
    assert_tables_equal_direct(spark, store, everything(*DROPS))


def test_results_and_export(spark, drops, tmp_path):
    trips = clean.clean_trips(source.read_csv(spark, str(drops / "2015-01.csv")))
    results = batch.temporal_results(trips)
    paths = source.write_results(results, str(tmp_path / "results"))
    stored = spark.read.json(paths["trips_by_hour"])
    assert sorted(rows(stored.select("hour", "trip_count"))) == sorted(rows(results["trips_by_hour"]))
    source.export_csv(trips.select("VendorID", "fare_amount"), str(tmp_path / "csv"))
    back = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert back.columns == ["VendorID", "fare_amount"] and back.count() == trips.count()


def test_build_all_tables(spark, drops, tmp_path):
    trips = clean.clean_trips(source.read_csv(spark, str(drops)))
    paths = T.build_all(trips, str(tmp_path / "tables"), route_min_trips=2)
    assert set(paths) == set(T.BUILDERS)
    assert spark.read.parquet(paths["summary_stats"]).first()["total_records"] == trips.count()


def test_batch_run(spark, drops, tmp_path):
    root = str(tmp_path / "root")
    results = batch.run_batch(
        spark, str(drops), root, stages=("temporal", "geospatial", "economic"), hotspot_min_trips=1
    )
    trips = TripStore(root).cleaned(spark)
    direct = {**batch.temporal_results(trips), **batch.geospatial_results(trips, min_trips=1), **batch.economic_results(trips)}
    assert set(results) == set(direct)
    for name in results:
        close(rows(results[name]), rows(direct[name]))
    again = batch.run_batch(
        spark, str(drops), root, stages=("temporal",), skip_ingestion=True, skip_cleaning=True, sample_fraction=0.5
    )
    assert again["trips_by_hour"].agg(F.sum("trip_count")).first()[0] < trips.count()
    with pytest.raises(ValueError):
        batch.run_batch(spark, str(drops), root, stages=("viz",))


def two_folders(tmp_path):
    """Files of one name, of different years, in two folders."""
    for folder, year, n in (("a", 2015, 30), ("b", 2016, 20)):
        (tmp_path / folder).mkdir()
        write_csv(tmp_path / folder / "yellow_01.csv", monthly(year, 1, n))
    return [str(tmp_path / f / "yellow_01.csv") for f in "ab"], monthly(2015, 1, 30) + monthly(2016, 1, 20)


@pytest.mark.parametrize("calls", [lambda a, b: [a, b], lambda a, b: [b, a], lambda a, b: [[a, b]], lambda a, b: [a, b, a]])
def test_equal_file_names_are_different_loads(spark, tmp_path, calls):
    (a, b), everything_ = two_folders(tmp_path)
    store = TripStore(str(tmp_path / "store"))
    for path in calls(a, b):
        incremental.load_csv(spark, store, path)
    assert_tables_equal_direct(spark, store, everything_)


def test_streams_of_two_folders(spark, tmp_path):
    _, everything_ = two_folders(tmp_path)
    store = TripStore(str(tmp_path / "store"))
    for folder in ("a", "b", "a"):
        arrivals.store_arrivals(spark, str(tmp_path / folder), store, str(tmp_path / f"checkpoint-{folder}")).awaitTermination()
    assert_tables_equal_direct(spark, store, everything_)


def test_streamed_and_loaded_files_are_the_same_loads(spark, tmp_path):
    (a, _), _ = two_folders(tmp_path)
    store = TripStore(str(tmp_path / "store"))
    arrivals.store_arrivals(spark, str(tmp_path / "a"), store, str(tmp_path / "checkpoint")).awaitTermination()
    incremental.load_csv(spark, store, a)
    assert_tables_equal_direct(spark, store, monthly(2015, 1, 30))


def test_a_batch_run_keeps_other_loads(spark, tmp_path):
    (tmp_path / "drops").mkdir()
    write_csv(tmp_path / "drops" / "2015-01.csv", DROPS["2015-01.csv"])
    later = write_csv(tmp_path / "2015-02.csv", DROPS["2015-02.csv"])
    root = str(tmp_path / "root")
    run = lambda **options: batch.run_batch(spark, str(tmp_path / "drops"), root, stages=("temporal",), **options)
    run()
    incremental.load_csv(spark, TripStore(root), later)
    run()
    assert_tables_equal_direct(spark, TripStore(root), everything("2015-01.csv", "2015-02.csv"))
    run(rebuild=True)
    assert_tables_equal_direct(spark, TripStore(root), everything("2015-01.csv"))


def test_a_refresh_lists_touched_months_only(spark, drops, tmp_path):
    store = TripStore(str(tmp_path / "store"))
    for name in DROPS:
        incremental.load_csv(spark, store, str(drops / name))
    files = store.cleaned(spark, [(2015, 2), (1999, 1)]).inputFiles()
    assert files and all("/year=2015/month=2/" in f for f in files)
    assert len(store.cleaned(spark).inputFiles()) > len(files)
    assert store.cleaned(spark, [(1999, 1)]).count() == 0


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from types import SimpleNamespace

    from curbline.session import shared_dir

    def session(master, base):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda *_: base), sparkContext=SimpleNamespace(master=master))

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session("spark://host:7077", None), "x")
    with pytest.raises(ValueError):
        shared_dir(session("local-cluster[2,1,1024]", None), "x")
    assert shared_dir(session("yarn", "hdfs:///shared/"), "x").startswith("hdfs:///shared/x-")
    assert shared_dir(session("local[4]", None), "x")
