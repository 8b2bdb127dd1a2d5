"""The pipeline, stage by stage on its own input, against brute force."""

import re

import pytest
from llm.conftest import TAKEN
from llm.test_jaccard import brute
from llm.test_native import base, level

import corpus_pipeline
from curbline.llm import mixing, quality, secrets
from curbline.session import settled

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        result = settled(stage(spark, docs, SF), "stage")
        out.append((name, docs, result))
        docs = result
    return out


def test_columns_and_rows(spark, stages):
    columns = stages[0][1].columns
    assert [len(set(r.columns) ^ set(columns)) for _, _, r in stages[:-1]] == [0] * 4
    for _, _, result in stages[:-1]:
        assert result.columns == columns
    run = corpus_pipeline.run(spark, SF)
    assert sorted(map(str, run.collect())) == sorted(map(str, stages[-1][2].collect()))


def test_rejected_documents_go(spark, stages):
    _, docs, kept = stages[0]
    scored = quality.quality_scores(docs, spark.read.parquet(f"{SF}/labels.parquet"), quality.crc_remainder("doc_id", 4) == 2)
    accepted = {r.doc_id for r in scored.where("predicted = 1").collect()}
    assert {tuple(r) for r in kept.collect()} == {tuple(r) for r in docs.collect() if r.doc_id in accepted}
    assert 0 < len(accepted) < docs.count()


def test_one_of_each_group_stays(stages):
    _, docs, kept = stages[1]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = {i for i, n, component in brute(rows) if i == component}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want) and len(want) < len(rows)


def test_secrets_are_masked(stages):
    _, docs, masked = stages[2]
    before, after = ({r.doc_id: r for r in df.collect()} for df in (docs, masked))
    assert set(before) == set(after)
    for i, r in after.items():
        assert not base(r.text) and r.n_chars == len(r.text)
        assert (r.text == before[i].text) == (secrets.MASK not in r.text)


def test_sources_meet_targets(stages):
    _, docs, mix = stages[3]
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    have, own, taken = {}, {}, {}
    for r in docs.collect():
        have[r.source] = have.get(r.source, 0) + words(r.text)
        own[r.doc_id] = r
    for r in mix.collect():
        assert r.text in own[r.doc_id].text or set(r.text.split()) <= set(own[r.doc_id].text.split())
        taken[r.source] = taken.get(r.source, 0) + words(r.text)
    want = level(have, mixing.WEIGHTS, mixing.SHARE, mixing.REPEATS)
    assert all(abs(taken[s] - want[s]) <= mixing.BLOCK_WORDS for s in have)


def test_texts_are_encoded(stages):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    _, docs, out = stages[4]
    want = sorted((r.doc_id, library.encode(r.text, add_special_tokens=False).ids) for r in docs.collect())
    assert sorted((r.doc_id, list(r.ids)) for r in out.collect()) == want


def test_odd_documents_pass_all_stages(spark, odd_docs, tmp_path):
    for name in ("labels", "documents"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0 if name == "labels" else 5).write.parquet(f"{tmp_path}/{name}.parquet")
    docs, sizes = odd_docs, []
    for _, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = settled(stage(spark, docs, str(tmp_path)), "odd")
        sizes.append(docs.count())
        for r in docs.collect():  # what the user brought stays as it was
            assert (r["score"], r["label"], r["prefix"]) == (0.5, 1, "p")
            assert [r[name] for name in TAKEN] == [f"{name} {r['doc_id']}" for name in TAKEN]
    n = odd_docs.count()
    assert sizes[0] == n and sizes[1] == n - 3 and sizes[2] == sizes[1]  # a repeated row, a variant, an edited copy
    assert set(columns) - {"text"} < set(docs.columns)


def test_nothing(spark, no_docs):
    docs = no_docs
    for _, stage in corpus_pipeline.STAGES:
        docs = settled(stage(spark, docs, SF), "none")
        assert docs.count() == 0
