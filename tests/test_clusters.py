"""k-means: fixed points, starts, and odd tables."""

import numpy as np
from pyspark.sql import functions as F

from curbline.operators import clusters
from curbline.operators.sampling import bottom_k
from curbline.session import settled


def plain(points, starts, rounds):
    centres = np.array(starts, float)
    for _ in range(rounds):
        near = ((points[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        new = np.array([points[near == i].mean(axis=0) if (near == i).any() else c for i, c in enumerate(centres)])
        if (new == centres).all():
            break
        centres = new
    return centres


def test_rounds_are_those_of_a_plain_loop(spark):
    draw = np.random.default_rng(1)
    points = draw.standard_normal((300, 2)) + 5 * draw.integers(0, 4, (300, 1))
    rows = settled(spark.createDataFrame([(float(x), float(y)) for x, y in points], "x double, y double"))
    starts = clusters._starts(rows, ("x", "y"), 4, 42, 300)
    found = clusters.kmeans(rows, ["x", "y"], 4, False)
    assert np.allclose(found.centres, plain(points, starts, clusters.MAX_ITERATIONS))
    assert np.allclose(clusters.kmeans(rows.repartition(5), ["x", "y"], 4, False).centres, found.centres)
    if found.settled:  # one more round changes nothing
        means = found.assigned(rows, "c").groupBy("c").agg(F.avg("x"), F.avg("y")).orderBy("c").collect()
        assert np.allclose([r[1:] for r in means], found.centres)


def test_few_points_many_copies_and_none(spark):
    rows = settled(spark.createDataFrame([(1.0, 1.0)] * 500 + [(2.0, 3.0), (4.0, 4.0)], "x double, y double"))
    found = clusters.kmeans(rows, ["x", "y"], 5, True)
    assert found.settled and len(found.centres) == 3  # no more different points
    counts = {r["c"]: r["count"] for r in found.assigned(rows, "c").groupBy("c").count().collect()}
    assert sorted(counts.values()) == [1, 1, 500]
    assert clusters.kmeans(rows.limit(0), ["x", "y"], 3, True).centres == ()
    same = clusters.kmeans(settled(rows.where("x = 1")), ["x", "y"], 3, True)
    assert len(same.centres) == 1


def test_bottom_k_is_the_sorted_head(spark):
    rows = spark.range(20_000).select("id", F.md5(F.col("id").cast("string")).alias("h")).repartition(5)
    want = [r["id"] for r in rows.orderBy("h").limit(30).collect()]
    assert [r["id"] for r in bottom_k(rows, F.col("h"), 30).collect()] == want
    assert [r["id"] for r in bottom_k(rows, F.col("h"), 30, rows=10**9).collect()] == want  # a threshold far too low
    assert bottom_k(rows.limit(0), F.col("h"), 30).count() == 0
    same = rows.withColumn("h", F.lit("ff"))
    assert bottom_k(same, F.col("h"), 30).count() == 30
