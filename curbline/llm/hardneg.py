"""Hard negatives by Fagin's threshold algorithm.

Scores are inner products of integer vectors. A shard of rows keeps one list a
dimension, sorted by component. An anchor reads the lists of its non-zero dimensions
from the end that its sign favours, all to the same depth; rows it meets are looked up
and scored whole, in integers. The sum of the anchor's components times the last ones
read is the threshold: no unread row scores more. Reading stops when the threshold is
strictly below the k-th score of every window (so ties are read too), or below the
window itself.

Two searches use it: the best rows of the anchor's own label (positives; one window
without bounds, shards by label) and then, for each positive, the best rows of other
labels within a window of scores below the positive's (shards over all labels).
Anchors meet shards in blocks, and the k best of every shard are merged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbline.llm.neardup import VALID
from curbline.session import settled

SCALE, POSITIVES, NEGATIVES = 256, 5, 3
#: A negative's score in hundredths of its positive's.
LEAST, MOST = 50, 95
#: Components of a shard, anchors of a block, and rows of a list read at first.
SHARD_VALUES, BLOCK_ANCHORS, DEPTH = 1 << 19, 4096, 64
#: Bounds that no score reaches.
ANY = (-(1 << 62), 1 << 62)


def _score_type(x: np.ndarray, a: np.ndarray) -> type:
    """A type in which all products are exact: doubles, which are faster, while small."""
    top = x.shape[1] * int(np.abs(x).max(initial=0)) * int(np.abs(a).max(initial=0))
    if top >= 1 << 62:
        raise OverflowError("inner products of these vectors do not fit 64-bit integers")
    return np.float64 if top < 1 << 53 else np.int64


def _top(rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """The k of ``rows`` with the largest scores; of equal ones those of smallest id."""
    if len(rows) > k:
        edge = np.partition(scores[rows], len(rows) - k)[len(rows) - k]
        rows = rows[scores[rows] >= edge]
    return rows[np.lexsort((ids[rows], -scores[rows]))[:k]]


def search(x: np.ndarray, ids: np.ndarray, usable: np.ndarray, order: np.ndarray, anchor: np.ndarray, windows: list[tuple[int, int]], k: int, depth: int = DEPTH) -> tuple[list[np.ndarray], np.ndarray, int]:
    """For each window (least and greatest score) the positions of its k best rows, by
    falling score and rising id; the scores of the rows read; and their number.

    ``x`` and ``anchor`` hold integers in a type that is exact for their products;
    ``order`` has the sorted lists, rising, one column a dimension. Rows not ``usable``
    are read, but belong to no window.
    """
    n, dims = len(x), np.flatnonzero(anchor)
    scores, seen = np.zeros(n, np.int64), np.zeros(n, bool)
    falling, weights = anchor[dims] > 0, anchor[dims]
    found, open_, at = [np.zeros(0, np.int64)] * len(windows), list(range(len(windows))), 0
    while open_ and at < n:
        end = min(n, max(depth, 2 * at)) if len(dims) else n
        lists = np.where(falling, order[::-1][at:end, dims], order[at:end, dims])
        met = np.full(n, end == n)  # at their end the lists have shown all rows
        met[lists] = True
        rows = np.flatnonzero(met & ~seen)
        seen[rows] = True
        scores[rows] = x[rows] @ anchor
        rows = rows[usable[rows]]
        threshold = int(x[lists[-1], dims] @ weights) if end < n else ANY[0]
        for w in list(open_):
            low, high = windows[w]
            inside = rows[(scores[rows] >= low) & (scores[rows] <= high)]
            found[w] = _top(np.concatenate([found[w], inside]), scores, ids, k)
            if threshold < low or len(found[w]) == k and threshold < scores[found[w][-1]]:
                open_.remove(w)
        at = end
    return found, scores, int(seen.sum())


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy().reshape(-1, dims)


def _best(rows: DataFrame, anchors: DataFrame, same: bool, k: int, shard_values: int) -> DataFrame:
    """(anchor_id, window, row_id, score, rank): of each of the ``windows`` of ``anchors``
    the k best of ``rows``; of the anchor's label if ``same``, else of others."""
    spark = rows.sparkSession
    part = F.col("label") if same else F.lit(0).cast("long")
    rows, anchors, by = rows.withColumn("part", part), anchors.withColumn("part", part), ["dims", "part"]
    shards = rows.groupBy(*by).agg(F.ceil(F.count("*") * F.first("dims") / shard_values).cast("int").alias("shards"))
    blocks = anchors.groupBy(*by).agg(F.ceil(F.count("*") / BLOCK_ANCHORS).cast("int").alias("blocks"))
    meets = shards.join(blocks, by)

    def dealt(side: DataFrame, own: str, other: str, to: str, every: str) -> DataFrame:
        nth = F.pmod(F.xxhash64("id"), F.col(own)).cast("int").alias(to)
        out = side.join(meets, by).select(*by, nth, F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(every), "id", "label", "vector", "windows")
        return out.select(*by, "shard", "block", "id", "label", "vector", "windows")

    none = F.lit(None).cast(anchors.schema["windows"].dataType)
    both = dealt(rows.withColumn("windows", none), "shards", "blocks", "shard", "block").union(dealt(anchors, "blocks", "shards", "block", "shard"))

    def scan(table: pa.Table) -> pa.Table:
        asks = table["windows"].is_valid().to_numpy()
        every, ids, labels = _matrix(table["vector"], table["dims"][0].as_py()), table["id"].to_numpy(), table["label"].to_numpy()
        exact = _score_type(every[~asks], every[asks])
        x, asking, own = every[~asks].astype(exact), every[asks].astype(exact), ids[~asks]
        order = np.argsort(x, axis=0, kind="stable").astype(np.int32)
        out: list[list] = [[], [], [], []]
        for anchor, at, windows in zip(asking, np.flatnonzero(asks), table["windows"].drop_null().to_pylist(), strict=True):
            usable = (own != ids[at]) & ((labels[~asks] == labels[at]) == same)
            found, scores, _ = search(x, own, usable, order, anchor, [(w["low"], w["high"]) for w in windows], k)
            for w, best in zip(windows, found, strict=True):
                for column, values in zip(out, ([ids[at]] * len(best), [w["window"]] * len(best), own[best], scores[best]), strict=True):
                    column.extend(values)
        return pa.table([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64()), strict=True)], ["anchor_id", "window", "row_id", "score"])

    key = [*by, "shard", "block"]
    grouped = both.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *key).groupBy(*key)
    found = grouped.applyInArrow(scan, "anchor_id long, window int, row_id long, score long")
    nth = F.row_number().over(Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "row_id"))
    return found.withColumn("rank", nth).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    relabel: Column | None = None,
    scale: int = SCALE,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least: int = LEAST,
    most: int = MOST,
    shard_values: int = SHARD_VALUES,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for
    each anchor and each of its positives the best negatives.

    ``vectors`` has vec_id, embedding and label (an integer); ``anchors`` is a condition
    on them and ``relabel`` a label to take in place of the row's. Components become
    floor(scale * x), and scores are inner products of these. Positives are the best rows
    of the anchor's label; negatives the best of other labels with least * positive <=
    100 * negative <= most * positive. Ties go to the smaller vec_id; an anchor's own
    vec_id is no candidate.

    Rows take no part if the vector is null, empty or holds a null or non-finite
    component, or if the label or vec_id is null; vectors of another number of dimensions
    are not compared. Repeated rows of one id, label and vector count once. Scores beyond
    64-bit integers are an error. Other columns are not read; an empty table gives none.
    """
    spark = vectors.sparkSession
    label = F.col("label") if relabel is None else relabel
    kept = vectors.where(f"coalesce(vec_id IS NOT NULL AND label IS NOT NULL AND {VALID}, false)")
    whole = F.transform(F.col("embedding").cast("array<double>"), lambda v: F.floor(F.lit(float(scale)) * v).cast("long"))
    kept = kept.select(F.col("vec_id").cast("long").alias("id"), label.cast("long").alias("label"), whole.alias("vector"), anchors.alias("asks"))
    rows = settled(kept.where("label IS NOT NULL").distinct().withColumn("dims", F.size("vector")), "vectors")
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    asking = rows.where("asks")
    if asking.isEmpty():
        return spark.createDataFrame([], result)

    def window(number, low, high) -> Column:
        return F.struct(number.cast("int").alias("window"), low.cast("long").alias("low"), high.cast("long").alias("high"))

    first = _best(rows, asking.withColumn("windows", F.array(window(F.lit(0), *map(F.lit, ANY)))), True, positives, shard_values)
    first = first.select("anchor_id", F.col("row_id").alias("positive_id"), F.col("score").alias("positive_score"), F.col("rank").alias("window"))
    first = settled(first, "positives")
    # a score's bounds as whole numbers; those of a negative score have nothing between
    share = F.col("positive_score").cast("decimal(20,0)")
    bounds = first.select("anchor_id", window(F.col("window"), F.ceil(share * least / 100), F.floor(share * most / 100)).alias("w"))
    bounds = bounds.where("w.low <= w.high").groupBy("anchor_id").agg(F.collect_list("w").alias("windows"))
    second = _best(rows, asking.join(bounds.withColumnRenamed("anchor_id", "id"), "id"), False, negatives, shard_values)
    found = second.join(first, ["anchor_id", "window"])
    return found.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("row_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
