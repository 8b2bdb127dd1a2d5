"""Fare regression: features, three model kinds, evaluation, storage, scoring."""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from curbline.functions import columns as C
from curbline.functions import filters
from curbline.operators import trees
from curbline.operators.sampling import SEED, bernoulli, on_test_side, spread
from curbline.session import settled
from curbline.sources import storage

log = logging.getLogger(__name__)

LABEL = "fare_amount"
# Feature columns in the order the models are trained on.
FEATURES = [
    "pickup_latitude",
    "pickup_longitude",
    "dropoff_latitude",
    "dropoff_longitude",
    "passenger_count",
    "trip_distance",
    "pickup_hour",
    "pickup_day_of_week",
    "pickup_month",
    "pickup_year",
]
# Folder of each saved model, in order of preference for scoring.
MODEL_FOLDERS = {
    "random_forest": "fare_prediction_rf_model",
    "gbt": "fare_prediction_gbt_model",
    "linear_regression": "fare_prediction_lr_model",
}
ALIASES = {"rf": "random_forest", "gradient_boosted": "gbt", "lr": "linear_regression"}

METRICS_SCHEMA = StructType(
    [
        StructField("model", StringType()),
        StructField("rmse", DoubleType()),
        StructField("mae", DoubleType()),
        StructField("r2", DoubleType()),
        StructField("training_rows", LongType()),
        StructField("test_rows", LongType()),
        StructField("error", StringType()),
    ]
)
# Columns that tell a row apart and read alike in other engines.
SPLIT_KEY = [C.PICKUP, "passenger_count"]
# Memory for the statistics of one pass over a tree level (MB), so that a level of all
# trees takes few passes; iterations between checkpoints of a boosted model.
TREE_OPTIONS = {"maxMemoryInMB": 1024, "checkpointInterval": 10}
# Training rows of a task, which holds their binned features: a forest has 100 row counts
# and node ids for each of them as well, but sends statistics of all its nodes a task.
ROWS_PER_TASK = {"random_forest": 800_000, "gbt": 400_000}
# Training rows up to which all kinds are fitted at the same time: boosting is some 500 short
# steps, one after the other, which leave most cores idle. Beyond, a fit fills the cores,
# and one after the other they hold the binned features of one model only.
ROWS_TOGETHER = 5_000_000
# Training rows up to which the library's own fits grow trees. By its fields a row of a forest
# has some 600 bytes there; more rows go to ``trees``, which holds 18 bytes a row.
ROWS_IN_LIBRARY = 500_000


@dataclass
class FareModel:
    name: str
    model: PipelineModel | None
    rmse: float | None = None
    mae: float | None = None
    r2: float | None = None
    training_rows: int | None = None
    test_rows: int | None = None
    error: str | None = None


def canonical(name: str) -> str:
    """Model key for a name, alias or saved folder name."""
    lowered = name.lower()
    by_folder = {folder: key for key, folder in MODEL_FOLDERS.items()}
    key = ALIASES.get(lowered, by_folder.get(lowered, lowered))
    if key not in MODEL_FOLDERS:
        raise ValueError(f"unknown model {name!r}")
    return key


def with_calendar_features(trips: DataFrame) -> DataFrame:
    """The calendar columns, computed the same way for training and scoring."""
    return trips.withColumns(
        {
            "pickup_hour": F.hour(C.PICKUP),
            "pickup_day_of_week": F.dayofweek(C.PICKUP),
            "pickup_month": F.month(C.PICKUP),
            "pickup_year": F.year(C.PICKUP),
        }
    )


def fare_features(trips: DataFrame) -> DataFrame:
    """Feature columns and label of the rows a model can learn from."""
    return filters.trainable(with_calendar_features(trips).select(*FEATURES, LABEL))


def _regressor(name: str, **params):
    trees = {"featuresCol": "features", "labelCol": LABEL, "seed": SEED, **TREE_OPTIONS}
    if name == "random_forest":  # node ids spare each row a way down 100 trees a level
        return RandomForestRegressor(**{**trees, "cacheNodeIds": True, "numTrees": 100, "maxDepth": 10, **params})
    if name == "gbt":  # one tree of few levels at a time: storing node ids costs more than the way down
        return GBTRegressor(**{**trees, "maxIter": 100, "maxDepth": 5, **params})
    common = {"featuresCol": "scaled_features", "labelCol": LABEL}
    return LinearRegression(**{**common, "maxIter": 100, "regParam": 0.01, **params})


def _pipeline(name: str, **params) -> Pipeline:
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="skip")
    if name != "linear_regression":  # standardising changes nothing for trees
        return Pipeline(stages=[assembler, _regressor(name, **params)])
    scaler = StandardScaler(inputCol="features", outputCol="scaled_features", withMean=True, withStd=True)
    return Pipeline(stages=[assembler, scaler, _regressor(name, **params)])


def regression_metrics(scored: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """RMSE, MAE, R2 and rows in one pass."""
    error = F.col(label) - F.col(prediction)
    sums = scored.agg(
        F.avg(error * error).alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
        F.var_pop(label).alias("variance"),
        F.count(error).alias("rows"),
    )
    return sums.select(
        F.sqrt("mse").alias("rmse"), "mae", (1 - F.try_divide("mse", "variance")).alias("r2"), "rows"
    )


def learning_rows(trips: DataFrame, fraction: float | None = None) -> DataFrame:
    """Features, label and ``is_test`` (one row in five by its values) of the rows a
    model learns from or is measured on. All trips, unless ``fraction`` asks for a
    sample; rows that lack a feature are left out, as no model can take them."""
    rows = with_calendar_features(trips).withColumn("is_test", on_test_side(SPLIT_KEY))
    rows = filters.trainable(rows.select(*FEATURES, LABEL, "is_test")).dropna(subset=FEATURES)
    return rows if fraction is None else bernoulli(rows, fraction)


def split_report(rows: DataFrame) -> DataFrame:
    """One row about ``learning_rows``: rows of each side, mean label of the training
    side, and the RMSE on the test side of predicting that mean."""
    test, label = F.col("is_test"), F.col(LABEL)
    sums = rows.agg(
        F.count_if(~test).alias("training_rows"),
        F.count_if(test).alias("test_rows"),
        F.avg(F.when(~test, label)).alias("mean_fare"),
        F.avg(F.when(test, label)).alias("m"),
        F.avg(F.when(test, label * label)).alias("s"),
    )
    gap = F.col("s") - 2 * F.col("mean_fare") * F.col("m") + F.col("mean_fare") ** 2
    return sums.select("training_rows", "test_rows", "mean_fare", F.sqrt(gap).alias("baseline_rmse"))


def tasks_for(training: DataFrame, name: str, count: int) -> int | None:
    """Tasks that ``count`` rows are dealt over for a fit; None to take them as they are stored."""
    limit = ROWS_PER_TASK.get(name)
    if limit is None or count <= limit:
        return None
    return max(-(-count // limit), training.rdd.getNumPartitions())


def _fitted(pipeline: Pipeline, training: DataFrame, name: str, count: int, partitions: int | None) -> PipelineModel:
    *before, last = pipeline.getStages()
    if count > ROWS_IN_LIBRARY and trees.growable(last):  # a task streams its blocks, so cores tell their number
        return PipelineModel([*before, trees.fitted(last, training, FEATURES, LABEL, partitions)])
    if partitions is None:
        partitions = tasks_for(training, name, count)
    return pipeline.fit(spread(training, partitions))


def fit_one(rows: DataFrame, name: str, counts, partitions: int | None = None, **params) -> FareModel:
    """Fit a model on the training side of stored ``learning_rows``. In the library's fits
    no task holds more than ``ROWS_PER_TASK`` of them, unless ``partitions`` tells the tasks."""
    training = rows.where(~F.col("is_test"))
    model = _fitted(_pipeline(name, **params), training, name, counts["training_rows"], partitions)
    m = regression_metrics(model.transform(rows.where("is_test"))).first()
    return FareModel(name, model, m["rmse"], m["mae"], m["r2"], counts["training_rows"], counts["test_rows"])


def train(
    trips: DataFrame,
    name: str = "random_forest",
    fraction: float | None = None,
    partitions: int | None = None,
    **params,
) -> FareModel:
    """Fit one model on 80 % of the trips and measure it on the other 20 %.

    All trips are used unless ``fraction`` asks for a sample. Features are computed
    once and stored, for the many passes of a fit; ``partitions`` spreads the rows
    over that many tasks (by default as many as ``tasks_for`` tells). Returns the fitted
    model with its hold-out metrics; only these numbers reach the driver.
    """
    rows = settled(learning_rows(trips, fraction), "features")
    return fit_one(rows, canonical(name), split_report(rows).first(), partitions, **params)


def train_all(
    trips: DataFrame, fraction: float | None = None, partitions: int | None = None, **params_by_model
) -> dict[str, FareModel]:
    """Train every kind on the same stored features; one that fails keeps its row,
    with the error and without a model."""
    rows = settled(learning_rows(trips, fraction), "features")
    counts = split_report(rows).first()

    def fitted(name: str) -> FareModel:
        try:
            return fit_one(rows, name, counts, partitions, **params_by_model.get(name, {}))
        except Exception as error:  # a failing model must not stop the others
            log.exception("training %s failed", name)
            return FareModel(name, None, error=f"{type(error).__name__}: {error}"[:500])

    together = len(MODEL_FOLDERS) if counts["training_rows"] <= ROWS_TOGETHER else 1
    with ThreadPoolExecutor(max_workers=together) as pool:
        return dict(zip(MODEL_FOLDERS, pool.map(fitted, MODEL_FOLDERS), strict=True))


def metrics_frame(spark: SparkSession, trained: dict[str, FareModel]) -> DataFrame:
    rows = [(m.name, m.rmse, m.mae, m.r2, m.training_rows, m.test_rows, m.error) for m in trained.values()]
    return spark.createDataFrame(rows, METRICS_SCHEMA)


def best_model(trained: dict[str, FareModel]) -> str | None:
    """Name of the model with the highest R2; None if none has one."""
    measured = {name: m.r2 for name, m in trained.items() if m.r2 is not None}
    return max(measured, key=measured.get, default=None)


def feature_importance(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """Importance per feature, largest first, summing to 1.

    Trees report their own; for a linear model it is the share of the absolute
    (standardised) coefficient.
    """
    last = model.stages[-1]
    if hasattr(last, "featureImportances"):
        weights = [float(w) for w in last.featureImportances.toArray()]
    else:
        sizes = [abs(float(c)) for c in last.coefficients]
        total = sum(sizes) or 1.0
        weights = [s / total for s in sizes]
    frame = spark.createDataFrame(list(zip(FEATURES, weights)), "feature string, importance double")
    return frame.orderBy(F.desc("importance"), "feature")


def save(trained: FareModel, folder: str) -> str:
    """Save the model, and its metrics merged with those of the other models."""
    spark = SparkSession.active()
    path = f"{folder.rstrip('/')}/{MODEL_FOLDERS[trained.name]}"
    trained.model.write().overwrite().save(path)
    (
        metrics_frame(spark, {trained.name: trained})
        .withColumn("key", F.col("model"))
        .coalesce(1)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("key")
        .json(f"{folder.rstrip('/')}/metrics")
    )
    return path


def load(spark: SparkSession, folder: str, name: str | None = None) -> PipelineModel:
    """A saved model; without a name, the first present in order of preference."""
    names = [canonical(name)] if name else list(MODEL_FOLDERS)
    for key in names:
        path = f"{folder.rstrip('/')}/{MODEL_FOLDERS[key]}"
        if storage.exists(spark, path):
            return PipelineModel.load(path)
    raise FileNotFoundError(f"no saved model among {names} in {folder}")


def saved_models(spark: SparkSession, folder: str) -> DataFrame:
    """Models present in a folder."""
    rows = [
        (key, f"{folder.rstrip('/')}/{sub}")
        for key, sub in MODEL_FOLDERS.items()
        if storage.exists(spark, f"{folder.rstrip('/')}/{sub}")
    ]
    return spark.createDataFrame(rows, "model string, path string")


def saved_metrics(spark: SparkSession, folder: str, name: str | None = None) -> DataFrame:
    """Stored hold-out metrics, of one model or of all."""
    stored = spark.read.schema(METRICS_SCHEMA).json(f"{folder.rstrip('/')}/metrics").select(*METRICS_SCHEMA.names)
    return stored if name is None else stored.where(F.col("model") == canonical(name))


def score_fares(trips: DataFrame, model: PipelineModel) -> DataFrame:
    """Trips with ``predicted_fare``.

    A missing distance is replaced by the great-circle distance of the trip's
    ends. Trips missing any other feature get no prediction and are left out.
    """
    distance = C.haversine_miles("pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude")
    ready = with_calendar_features(trips).withColumn("trip_distance", F.coalesce("trip_distance", distance))
    scored = model.transform(ready)
    return scored.drop("features", "scaled_features").withColumnRenamed("prediction", "predicted_fare")
