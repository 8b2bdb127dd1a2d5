"""op12: against brute force in whole numbers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from curbline.llm import hardneg

COLUMNS = "vec_id long, embedding array<double>, label int, shard int, window string, score double"


def rows_of(seed, n=400, dims=6, copies=60):
    draw = np.random.default_rng(seed)
    rows = [(i, (draw.standard_normal(dims) * draw.choice([0.1, 1.0])).tolist(), int(draw.integers(4)), 0, "w", 0.0) for i in range(n)]
    rows += [(n + i, rows[50][1], int(draw.integers(4)), 0, "w", 0.0) for i in range(copies)]  # ties
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [nan] * dims, [inf] * dims, [None] * dims, [1.0, 2.0], [2.0, 1.0], [0.0] * dims]
    rows += [(5000 + 50 * i, e, 1, 0, "w", 0.0) for i, e in enumerate(odd)]
    return [*rows, (6000, [1.0] * dims, None, 0, "w", 0.0), (None, [1.0] * dims, 1, 0, "w", 0.0), rows[3], rows[50]]


def brute(rows, every=50):
    whole = {}
    for vec_id, e, label, *_ in rows:
        if vec_id is not None and label is not None and e and all(x is not None and math.isfinite(x) for x in e):
            whole[vec_id] = ((label + 1) % 4 if vec_id % 7 == 0 else label, [math.floor(256 * x) for x in e])
    out = []
    for a, (label, v) in whole.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), b, other) for b, (other, w) in whole.items() if b != a and len(w) == len(v))
        for p, b, _ in [s for s in scored if s[2] == label][:5]:
            inside = [s for s in scored if s[2] != label and 50 * -p <= 100 * -s[0] <= 95 * -p]
            out += [(a, b, at + 1, c, -p, -n) for at, (n, c, _) in enumerate(inside[:3])]
    return sorted(out)


@pytest.mark.parametrize(("seed", "shard_values"), [(1, 1 << 19), (2, 300), (3, 60)])
def test_hard_negatives(spark, monkeypatch, seed, shard_values):
    monkeypatch.setattr(hardneg, "BLOCK_ANCHORS", 3)
    monkeypatch.setattr(hardneg, "DEPTH", 4)
    rows = rows_of(seed)
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 4).otherwise(F.col("label"))
    found = hardneg.hard_negatives(spark.createDataFrame(rows, COLUMNS), F.col("vec_id") % 50 == 0, moved, shard_values=shard_values)
    assert sorted(tuple(r) for r in found.collect()) == brute(rows)


def test_reading_stops_early():
    """A few dimensions decide: most rows are never scored, and the result is exact."""
    draw = np.random.default_rng(4)
    x = np.floor(256 * draw.standard_normal((20_000, 3)) * [1, 0.1, 0.01]).astype(float)
    order, ids = np.argsort(x, axis=0, kind="stable"), np.arange(len(x))
    anchor = np.array([200.0, -3.0, 0.0])
    scores = (x @ anchor).astype(int)
    top = int(scores.max())
    (best, below), _, scored = hardneg.search(x, ids, ids % 2 == 0, order, anchor, [hardneg.ANY, (top // 2, top * 95 // 100)], 3)
    want = sorted(ids[::2], key=lambda i: (-scores[i], i))
    assert best.tolist() == want[:3]
    assert below.tolist() == [i for i in want if scores[i] <= top * 95 // 100][:3]
    assert scored < 0.1 * len(x)


def test_empty_and_large(spark):
    none = spark.createDataFrame([], COLUMNS)
    assert hardneg.hard_negatives(none, F.col("vec_id") % 50 == 0).collect() == []
    few = spark.createDataFrame([(1, [1.0], 0, 0, "", 0.0), (50, [2.0], 0, 0, "", 0.0), (3, [0.5], 1, 0, "", 0.0), (4, [9.0], 1, 0, "", 0.0)], COLUMNS)
    got = hardneg.hard_negatives(few, F.col("vec_id") % 50 == 0).collect()
    assert [tuple(r) for r in got] == [(50, 1, 1, 3, 512 * 256, 512 * 128)]
    # products beyond doubles, within 64-bit integers, are exact
    big = [(50, [2.0**20, 3.0], 0, 0, "", 0.0), (1, [2.0**20 + 1 / 256, 1.0], 0, 0, "", 0.0), (2, [2.0**19 + 1 / 256, 1.0], 1, 0, "", 0.0)]
    got = hardneg.hard_negatives(spark.createDataFrame(big, COLUMNS), F.col("vec_id") == 50).collect()
    assert [(r["positive_score"], r["negative_score"]) for r in got] == [(2**28 * (2**28 + 1) + 768 * 256, 2**28 * (2**27 + 1) + 768 * 256)]
