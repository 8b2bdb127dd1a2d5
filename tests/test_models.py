import pytest
from pyspark.sql import functions as F

from conftest import trip
from curbline.functions import columns as C
from curbline.operators import clean, clusters, models

SMALL = {
    "random_forest": {"numTrees": 8, "maxDepth": 5},
    "gbt": {"maxIter": 5, "maxDepth": 3},
    "linear_regression": {},
}


@pytest.fixture(scope="module")
def trained(small_trips):
    return models.train_all(small_trips, **SMALL)


def test_every_model_beats_the_mean(trained, small_trips):
    assert set(trained) == set(models.MODEL_FOLDERS)
    spread = small_trips.agg(F.stddev("fare_amount")).first()[0]
    for m in trained.values():
        assert m.rmse < spread and m.mae <= m.rmse and 0 < m.r2 <= 1
        assert m.training_rows + m.test_rows == models.fare_features(small_trips).count()


def test_training_is_repeatable(trained, small_trips):
    again = models.train(small_trips, "lr")
    assert (again.rmse, again.r2) == pytest.approx((trained["linear_regression"].rmse, trained["linear_regression"].r2))


def test_metrics_against_spark_evaluator(trained, small_trips):
    from pyspark.ml.evaluation import RegressionEvaluator

    scored = trained["linear_regression"].model.transform(models.fare_features(small_trips))
    mine = models.regression_metrics(scored).first()
    for name in ("rmse", "mae", "r2"):
        theirs = RegressionEvaluator(labelCol="fare_amount", metricName=name).evaluate(scored)
        assert mine[name] == pytest.approx(theirs)


def test_importances_sum_to_one(spark, trained):
    for m in trained.values():
        out = models.feature_importance(spark, m.model).collect()
        assert [r["feature"] for r in out].count("trip_distance") == 1 and len(out) == len(models.FEATURES)
        assert sum(r["importance"] for r in out) == pytest.approx(1)
        assert [r["importance"] for r in out] == sorted((r["importance"] for r in out), reverse=True)


def test_save_load_and_merge_of_metrics(spark, trained, small_trips, tmp_path):
    folder = str(tmp_path / "models")
    models.save(trained["linear_regression"], folder)
    loaded = models.load(spark, folder)
    a = models.score_fares(small_trips, loaded).agg(F.sum("predicted_fare")).first()[0]
    b = models.score_fares(small_trips, trained["linear_regression"].model).agg(F.sum("predicted_fare")).first()[0]
    assert a == pytest.approx(b)
    models.save(trained["random_forest"], folder)
    models.save(trained["linear_regression"], folder)
    assert sorted(r["model"] for r in models.saved_metrics(spark, folder).collect()) == ["linear_regression", "random_forest"]
    assert models.saved_metrics(spark, folder, "rf").first()["r2"] == pytest.approx(trained["random_forest"].r2)
    assert models.saved_models(spark, folder).count() == 2
    # the forest is preferred once it is there
    assert "RandomForest" in type(models.load(spark, folder).stages[-1]).__name__
    with pytest.raises(FileNotFoundError):
        models.load(spark, folder, "gbt")


def test_one_failing_model_does_not_stop_the_others(small_trips):
    out = models.train_all(small_trips, random_forest={"numTrees": -1}, gbt={"maxIter": 1, "maxDepth": 1})
    assert [name for name, m in out.items() if m.error] == ["random_forest"]
    assert out["random_forest"].model is None and "numTrees" in out["random_forest"].error
    assert models.best_model(out) in ("gbt", "linear_regression") and models.best_model({}) is None
    assert models.best_model({"gbt": models.FareModel("gbt", None)}) is None


def test_names():
    assert models.canonical("RF") == "random_forest"
    assert models.canonical("gradient_boosted") == "gbt"
    assert models.canonical("fare_prediction_lr_model") == "linear_regression"
    with pytest.raises(ValueError):
        models.canonical("svm")


def test_scoring_fills_distance_and_uses_sunday_first(spark, raw, trained):
    model = trained["linear_regression"].model
    cleaned = clean.clean_trips(raw([trip()]))
    flown = C.haversine_miles("pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude")
    without = cleaned.withColumn("trip_distance", F.lit(None).cast("double"))
    scored = models.score_fares(without, model).first()
    given = models.score_fares(cleaned.withColumn("trip_distance", flown), model).first()
    assert scored["predicted_fare"] == pytest.approx(given["predicted_fare"])
    assert scored["pickup_day_of_week"] == 2  # 2015-01-05 is a Monday


def test_clusters_cover_all_trips(small_trips):
    out = clusters.spatial_clusters(small_trips, 5, partitions=3)
    assert out.count() == 5
    assert out.agg(F.sum("trip_count")).first()[0] == small_trips.count()
    segments = clusters.trip_segments(small_trips, 3)
    assert segments.agg(F.sum("customer_count")).first()[0] == small_trips.count()


def test_customer_segments_keep_revenue(small_trips):
    inputs = clusters.segment_inputs(small_trips)
    assert inputs.where("no_tip_rate IS NULL OR high_tipper_rate IS NULL").count() == 0
    out = clusters.customer_segments(inputs)
    assert out.count() == 4
    fares = small_trips.agg(F.sum("fare_amount")).first()[0]
    assert out.agg(F.sum("total_revenue")).first()[0] == pytest.approx(fares)


def test_only_the_linear_model_is_standardised(trained):
    kinds = {name: [type(stage).__name__ for stage in m.model.stages] for name, m in trained.items()}
    assert {name for name, stages in kinds.items() if "StandardScalerModel" in stages} == {"linear_regression"}
