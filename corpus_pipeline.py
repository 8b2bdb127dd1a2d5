"""From raw documents to token ids in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept;
``run`` writes every stage's rows as Parquet to shared storage and reads them again
as the next one's input, so a lost executor costs a part of one stage. All stages but the last
return the columns of ``documents``. No stage is a cap, a prefix or a sample.

Null and empty texts: scored like texts without n-grams; in no group of copies;
without secrets; without words, so in no mix. Repeated rows are copies of each
other, of which one stays. Extra columns keep their names and values, whatever these
are; the last stage alone has columns of its own (n_tokens, ids) in place of any so named.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curbline.llm import bpe, jaccard, mixing, quality, secrets
from curbline.llm.names import quoted, unused
from curbline.llm.registry import VOCABULARY, table
from curbline.session import settled

def _counted(docs: DataFrame) -> DataFrame:
    """``docs`` with n_chars, if it is a column, as the length of the text."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.length("text").cast(kind))


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts. It learns from the labels table, as
    op5 does; documents that are held out there teach nothing here either."""
    taught = ~(quality.crc_remainder("doc_id", 4) == 2)
    labels = table(spark, sf_dir, "labels").where(taught).select("doc_id", F.col("quality").alias("label"))
    model = quality.train(docs.select("doc_id", "text"), labels)
    score = unused(docs, "score")
    scored = quality.with_scores(docs, model, name=score)
    return scored.where(F.col(score) >= (quality.ACCEPT if model is not None else 0.0)).drop(score)


def keep_one_of_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of smallest id, null last.

    Rows are told apart by a hash of id and text, so ids may repeat.
    """
    key, nth = unused(docs, "key"), unused(docs, "nth")
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    found = jaccard.near_duplicates(keyed.select(key, "text"), id_column=key).where("n_shingles > 0")
    group = found.select(F.col("doc_id").alias(key), F.col("component_id").alias("component")).distinct()
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", key)).alias("first")
    kept = keyed.select("doc_id", key).join(group, key).groupBy("component").agg(first)
    kept = settled(kept.select(F.col("first")[key].alias(key), F.col("first")["doc_id"].alias("kept_id")), "kept")
    has_words = F.coalesce(F.rlike("text", F.lit(mixing.WORD)), F.lit(False))
    same = (keyed[key] == kept[key]) & keyed["doc_id"].eqNullSafe(kept["kept_id"])
    copies = keyed.where(has_words).join(kept, same, "left_semi")
    rows = Window.partitionBy(key, "doc_id").orderBy(*[F.col(quoted(c)) for c in ("lang", "source", "n_chars") if c in docs.columns], key)
    one = copies.withColumn(nth, F.row_number().over(rows)).where(F.col(nth) == 1).drop(key, nth)
    return one.union(docs.where(~has_words))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets found in them masked."""
    return _counted(secrets.redacted(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes, a row a document and pass."""
    return _counted(mixing.mixed(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text in place of the text."""
    return bpe.encode_column(docs, VOCABULARY).drop("text")


STAGES = [
    ("quality classifier", accept_quality),
    ("n-gram Jaccard join", keep_one_of_copies),
    ("secret scans", mask_secrets),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding and decoding", encode),
]

#: SQL cannot express a fitted classifier; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
