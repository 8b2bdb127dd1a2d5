"""Trees grown over blocks of rows against the ML library's own."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from curbline.operators import models, trees

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    """Features of few values, so that both sides have the same value ranges."""
    made = spark.range(3000, numPartitions=3).select(
        (F.col("id") % 17).cast("double").alias("a"),
        (F.col("id") * 7 % 23 / 4).alias("b"),
        (F.col("id") * 13 % 5).cast("int").alias("c"),
        "id",
    )
    label = F.col("a") * F.col("b") + 3 * F.col("c") + (F.col("id") * 31 % 101) / 50
    return made.withColumn("y", label).drop("id").localCheckpoint()


def assembled(rows):
    return VectorAssembler(inputCols=NAMES, outputCol="features").transform(rows)


def predicted(model, rows):
    return np.array([r[0] for r in model.transform(assembled(rows)).select("prediction").collect()])


def gbt(**params):
    return GBTRegressor(featuresCol="features", labelCol="y", seed=42, **params)


def forest(**params):
    return RandomForestRegressor(featuresCol="features", labelCol="y", seed=42, **params)


def test_boosted_trees_are_those_of_the_library(rows, monkeypatch):
    monkeypatch.setattr(trees, "TREES_CHAINED", 3)
    for params in ({"maxIter": 8, "maxDepth": 4}, {"maxIter": 2, "maxDepth": 3, "minInstancesPerNode": 200, "stepSize": 0.5}):
        theirs = gbt(**params).fit(assembled(rows))
        mine = trees.fitted(gbt(**params), rows, NAMES, "y", tasks=2)
        assert mine.totalNumNodes == theirs.totalNumNodes and mine.treeWeights == theirs.treeWeights
        assert predicted(mine, rows) == pytest.approx(predicted(theirs, rows))
        assert mine.featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray())


def test_a_forest_of_one_tree_and_no_draw_is_that_of_the_library(rows, monkeypatch):
    """Each row drawn once: then a forest of one tree tries all features, as the library's."""
    held = trees.blocks(rows, NAMES, "y", cuts := trees.value_ranges(rows, NAMES, 32), 2).collect()
    s = trees.settings(forest(numTrees=1, maxDepth=4), 3)
    monkeypatch.setattr(trees, "_bag", lambda s, tree, number, n: np.ones(n, np.uint8))
    grown = trees.Tree(s.depth)
    for level in range(s.depth):
        every = np.broadcast_to(np.arange(3), (1 << level, 3))
        (_, sums), = trees._bagged_sums(iter(held), {0: grown}, {0: every}, level, s)
        grown.place(level, trees.best_splits(sums, every, s))
    theirs = forest(numTrees=1, maxDepth=4, bootstrap=False).fit(assembled(rows))
    nodes = grown.nodes(cuts)
    assert len(nodes) == theirs.totalNumNodes
    assert nodes[0][3] == [3000.0, *[pytest.approx(v) for v in rows.agg(F.sum("y"), F.sum(F.col("y") ** 2)).first()]]


def test_a_forest_is_as_good_as_the_library(rows):
    """Other draws, the same method; saved trees are read back with all their nodes."""
    theirs = forest(numTrees=30, maxDepth=6).fit(assembled(rows))
    mine = trees.fitted(forest(numTrees=30, maxDepth=6), rows, NAMES, "y")
    y = np.array([r[0] for r in rows.select("y").collect()])
    off = [np.sqrt(np.mean((predicted(m, rows) - y) ** 2)) for m in (mine, theirs)]
    assert off[0] == pytest.approx(off[1], rel=0.15) and off[0] < y.std() / 3
    assert mine.getNumTrees == 30 and mine.numFeatures == 3
    assert len({t.toDebugString.split("\n", 1)[1] for t in mine.trees}) == 30


def test_trees_do_not_depend_on_the_tasks(rows):
    for regressor in (forest(numTrees=3, maxDepth=4), gbt(maxIter=3, maxDepth=3)):
        one, many = (trees.fitted(regressor, rows, NAMES, "y", tasks=n) for n in (1, 5))
        assert predicted(one, rows) == pytest.approx(predicted(many, rows))


def test_draws_are_poisson_and_the_same_in_every_pass():
    s = trees.settings(forest(numTrees=2), 3)
    drawn = trees._bag(s, 1, 5, 200_000)
    assert (drawn == trees._bag(s, 1, 5, 200_000)).all() and (drawn != trees._bag(s, 0, 5, 200_000)).any()
    assert drawn.mean() == pytest.approx(1, abs=0.02) and drawn.var() == pytest.approx(1, abs=0.03)
    assert (drawn == 0).mean() == pytest.approx(np.exp(-1), abs=0.01)


def test_a_row_is_a_byte_a_feature_and_a_label(spark, rows):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    held = trees.blocks(rows, NAMES, "y", trees.value_ranges(rows, NAMES, 32), 4).collect()
    assert sum(codes.nbytes + labels.nbytes for _, codes, labels in held) == 3000 * (3 + 8)
    assert len({number for number, _, _ in held}) == len(held) > 1
    trees.fitted(gbt(maxIter=2, maxDepth=2), rows, NAMES, "y")
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_value_ranges_by_quantiles_of_all_rows(spark):
    made = spark.range(10_000).select(F.col("id").cast("double").alias("x"), F.lit(7).alias("same"))
    many, none = trees.value_ranges(made, ["x", "same"], 32)
    assert len(many) == 31 and np.diff(many) == pytest.approx(10_000 / 32, abs=3) and len(none) == 0


def test_equal_labels_give_one_leaf_and_missing_ones_an_error(rows):
    flat = trees.fitted(gbt(maxIter=2, maxDepth=3), rows.withColumn("y", F.lit(0.1)), NAMES, "y")
    assert flat.totalNumNodes == 2 and predicted(flat, rows) == pytest.approx(0.1)
    with pytest.raises(Exception, match="finite"):
        trees.fitted(gbt(maxIter=1), rows.withColumn("y", F.lit(float("nan"))), NAMES, "y")


def test_other_parameters_go_to_the_library():
    assert trees.growable(models._regressor("gbt")) and trees.growable(models._regressor("random_forest"))
    assert not trees.growable(models._regressor("linear_regression"))
    assert not trees.growable(models._regressor("gbt", subsamplingRate=0.5))
    assert not trees.growable(models._regressor("random_forest", maxDepth=20))


def test_many_rows_are_fitted_in_blocks(small_trips, tmp_path, spark, monkeypatch):
    own = []
    grow = trees.fitted
    monkeypatch.setattr(trees, "fitted", lambda *args: own.append(args[-1]) or grow(*args))
    small = {"random_forest": {"numTrees": 8, "maxDepth": 5}, "gbt": {"maxIter": 5, "maxDepth": 3}}
    theirs = models.train_all(small_trips, **small)
    assert not own
    monkeypatch.setattr(models, "ROWS_IN_LIBRARY", 0)
    monkeypatch.setattr(models, "ROWS_PER_TASK", {"gbt": 10, "random_forest": 10})  # the library's alone
    mine = models.train_all(small_trips, **small)
    assert own == [None, None] and not any(m.error for m in mine.values())
    for name, m in mine.items():
        assert (m.training_rows, m.test_rows) == (theirs[name].training_rows, theirs[name].test_rows)
        assert m.r2 > 0.85 and theirs[name].r2 > 0.85  # eight trees, which few features decide
    models.save(mine["gbt"], str(tmp_path))
    loaded = models.load(spark, str(tmp_path), "gbt")
    a, b = (models.score_fares(small_trips, m).agg(F.sum("predicted_fare")).first()[0] for m in (loaded, mine["gbt"].model))
    assert a == pytest.approx(b)
    wrong = models.train_all(small_trips, random_forest={"numTrees": -1}, gbt=small["gbt"])
    assert "numTrees" in wrong["random_forest"].error
