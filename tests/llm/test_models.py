"""op5 and op9: held-out accuracy, gradients, and odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from curbline.llm import langid, quality, samples

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_quality_of_held_out_documents(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    out = quality.quality_scores(docs, labels, quality.crc_remainder("doc_id", 4) == 2)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"] and out.count() == docs.count()
    held = out.join(labels, "doc_id").where("held_out").select("score", "predicted", "quality").toPandas()
    assert ((held.score >= 0.7) == (held.predicted == 1)).all() and held.score.between(0, 1).all()
    assert (held.predicted == held.quality).mean() >= 0.98
    assert (held.predicted[held.quality == 1] == 1).mean() >= 0.99


def test_quality_learns_nothing_from_held_out_labels(spark, docs):
    some = docs.where("doc_id < 400")
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("doc_id < 400")
    held = quality.crc_remainder("doc_id", 4) == 2
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted(map(tuple, quality.quality_scores(some, x, held).collect())) for x in (labels, turned))
    assert a == b


def test_quality_of_odd_documents(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (2, 0), (4, 1), (5, 0), (5, None), (None, 1), (6, 1), (77, 0)], "doc_id long, quality int")
    never = F.lit(False)
    out = quality.quality_scores(odd_docs, labels, never).collect()
    assert len(out) == odd_docs.count() and all(0 <= r.score <= 1 for r in out)
    same = [r.score for r in out if r.doc_id == 5]
    assert same[0] == same[1]
    one_class = quality.quality_scores(odd_docs, labels.where("quality = 1"), never).collect()
    assert min(r.score for r in one_class) > 0.5
    nothing = quality.quality_scores(odd_docs, labels.limit(0), never).collect()
    assert {r.score for r in nothing} == {0.5} and len(nothing) == len(out)
    assert quality.quality_scores(no_docs, labels, never).count() == 0


def test_indicators_do_not_depend_on_chunks():
    texts = ["Abc abc  def!", "", "x", "Der Der Der\nUND und", "é" * 5]
    whole = [t.encode() for t in texts]
    bounds = np.cumsum([0, *map(len, whole)])
    slots, owner = quality.indicators(np.frombuffer(b"".join(whole), np.uint8), bounds)
    for i, one in enumerate(whole):
        alone, _ = quality.indicators(np.frombuffer(one, np.uint8), np.array([0, len(one)]))
        assert set(alone.tolist()) == set(slots[owner == i].tolist())


def test_languages_of_held_out_documents(docs):
    out = langid.language_report(docs, quality.crc_remainder("doc_id", 3) == 1)
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"] and out.count() == docs.count()
    held = out.where("held_out").join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert (held.lang_pred == held.lang).mean() >= 0.99 and held.score.between(0, 1).all()


def test_languages_of_odd_documents(odd_docs, no_docs):
    out = langid.language_report(odd_docs, F.lit(False))
    rows = out.collect()
    assert len(rows) == odd_docs.count()
    found = {r.doc_id: r for r in rows}
    assert [found[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and found[1].score == 0
    assert {r.lang_pred for r in rows} <= {"und", "en", "fr", "de", "es"}
    digits = odd_docs.withColumn("text", F.lit("12 ²  _ 34"))
    assert {r.lang_pred for r in langid.language_report(digits, F.lit(False)).collect()} == {"und"}
    nothing = langid.language_report(odd_docs, F.lit(True)).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}
    assert langid.language_report(no_docs, F.lit(False)).count() == 0


def test_samples_have_rare_labels(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    hashed = {r.doc_id: r.h for r in docs.select("doc_id", F.xxhash64("doc_id").alias("h")).collect()}
    order = sorted(hashed, key=hashed.get)
    rare = order[-3:]  # the last that hashes alone would take
    label = F.when(F.col("doc_id").isin(rare), "fr").when(F.col("doc_id") % 2 == 0, "en").otherwise("de")
    got = [(int(r.text), r.label) for r in samples.labelled_sample(docs, docs.select("doc_id", label.alias("label")), 300).collect()]
    assert sorted(i for i, _ in got) == sorted(order[:297] + rare)
    assert sorted(i for i, said in got if said == "fr") == sorted(rare)
    many = docs.select("doc_id", (F.col("doc_id") % 40).alias("label"))
    assert len({r.label for r in samples.labelled_sample(docs, many, 40).collect()}) == 40


def test_gradients_are_those_of_the_loss():
    draw = np.random.default_rng(0)
    net = langid.Network.drawn(3, 4, draw)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    rows, sizes, labels = draw.integers(97, 123, (5, langid.PIECE)).astype(np.uint8), np.array([7, 5, 5, 2, 1]), np.array([0, 1, 2, 1, 0])

    def loss():
        active = np.searchsorted(-sizes, -np.arange(sizes[0]), "left")
        forth, back = (net._read(rows, active, way, False)[0].astype(np.float64) for way in "fb")
        total = 0.0
        for t, n in enumerate(active):
            p = langid.softmax(np.concatenate([forth[t, :n], back[t, :n]], axis=1) @ net.w["v"] + net.w["c"])
            total -= np.log(p[np.arange(n), labels[:n]]).sum()
        return total / sizes.sum()

    for name, g in net.gradients(rows, sizes, labels).items():
        for _ in range(5):
            at = tuple(int(draw.integers(0, s)) for s in g.shape)
            at = (int(rows[draw.integers(0, 5), 0]), at[1]) if name[0] == "x" else at
            kept = net.w[name][at]
            net.w[name][at] = kept + 1e-2
            up = loss()
            net.w[name][at] = kept - 1e-2
            down = loss()
            net.w[name][at] = kept
            assert g[at] == pytest.approx((up - down) / 2e-2, rel=0.02, abs=1e-4)
