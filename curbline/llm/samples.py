"""Bounded samples of labelled rows, for fitting models."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


#: Rows of each label that a sample takes before any others.
LEAST_OF_LABEL = 100


def labelled_sample(docs: DataFrame, marked: DataFrame, sample_docs: int, least: int = LEAST_OF_LABEL) -> DataFrame:
    """(draw, text, label, one) of at most ``sample_docs`` rows of ``docs`` (doc_id,
    text) that ``marked`` (doc_id, label) labels; null labels and ids mark nothing.

    The ids of smallest hash are taken first, but before them ``least`` of each label,
    or all it has, so that rare labels are learned. Where even these are too many, all
    labels get one row, then a second and so on. So texts are joined with a table of
    bounded size and read whole; the outcome is bounded again, as ids may repeat.
    """
    ids = marked.where("label IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "label")
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id"), F.col("label")]
    nth = F.row_number().over(Window.partitionBy("label").orderBy(*by_hash))
    # rows of smallest hash have the same place within their label as among all rows
    common = ids.orderBy(*by_hash).limit(sample_docs).withColumn("nth", nth).where(F.col("nth") > least)
    ids = ids.withColumn("nth", nth).where(F.col("nth") <= least).union(common.withColumn("nth", F.lit(least + 1)))
    ids = ids.orderBy("nth", *by_hash).limit(sample_docs)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(ids), "doc_id")
    rows = rows.withColumn("draw", F.xxhash64("doc_id", "text"))
    return rows.orderBy("nth", "draw", "label").limit(sample_docs).select("draw", "text", "label", F.lit(1).alias("one"))
