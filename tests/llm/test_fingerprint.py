"""op11: sketches against sets of shingles, neighbours against a plain loop."""

import hashlib
import random

import numpy as np
import pytest

from curbline.llm import fingerprint as fp


def shingles(text):
    return {text[i : i + 8] for i in range(max(1, len(text) - 7))} if text else set()


def prose(draw, n):
    return " ".join("".join(draw.choice("abcdeé\U0001f600") for _ in range(draw.randint(2, 8))) for _ in range(n))


def test_sketches_keep_what_the_rules_say():
    draw = random.Random(3)
    texts = ["", "a", "abcdefg", "abcdefgh", "x" * 5000, *[prose(draw, n) for n in (2, 5, 20, 300, 3000)]]
    found = fp.sketches(texts)
    alone = [fp.sketches([t])[0] for t in texts]
    for text, sketch, own in zip(texts, found, alone, strict=True):
        assert sketch.tolist() == own.tolist() == sorted(set(sketch.tolist()))
        every = {int(h) for s in shingles(text) for h in fp.sketches([s])[0]}
        if len(text) >= 8:
            below = sorted(h for h in every if h <= int(fp.CUT))
            assert sketch.tolist() == (below if len(below) >= fp.LEAST else sorted(every)[: fp.LEAST])
        assert len(sketch) == min(len(every), max(fp.LEAST, len(sketch)))
        assert fp.read(fp.written(sketch)).tolist() == sketch.tolist()


def test_merged_is_the_sketch_of_both():
    draw = random.Random(5)
    texts = ["", "one", *[prose(draw, n) for n in (3, 10, 400, 2000)]]
    for a in texts:
        for b in texts:
            every = {int(h) for t in (a, b) for s in shingles(t) for h in (fp.sketches([s])[0] if len(t) >= 8 else fp.sketches([t])[0])}
            below = sorted(h for h in every if h <= int(fp.CUT))
            want = below if len(below) >= fp.LEAST else sorted(every)[: fp.LEAST]
            assert fp.merged(*fp.sketches([a, b])).tolist() == want


def test_containment_of_unequal_texts():
    draw = random.Random(7)
    long = prose(draw, 40_000)
    part, other = long[5000:25_000], prose(draw, 3000)
    whole, inside, outside, mixed = fp.sketches([long, part, other, part + other])
    assert fp.containment(inside, whole) > 0.99 and fp.containment(outside, whole) < 0.02
    assert abs(fp.containment(mixed, whole) - len(shingles(part)) / len(shingles(part + other))) < 0.06
    assert abs(fp.likeness(inside, whole) - len(shingles(part)) / len(shingles(long))) < 0.05
    none = np.zeros(0, np.uint64)
    assert fp.likeness(none, none) == 1.0 and fp.likeness(none, whole) == 0.0
    assert fp.containment(none, whole) == 1.0 and 0.0 <= fp.containment(fp.sketches(["ab"])[0], whole) <= 1.0


def report(rows):
    """The contract's columns by a plain loop; rows by id, nulls first."""
    out = []
    for at, (doc_id, text) in enumerate(rows):
        following = rows[(at + 1) % len(rows)][1]
        q = len(text) // 4
        edited = text[: len(text) - q] + following[:q]
        a, e, b = fp.sketches([text, edited, following])
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), fp.written(a), fp.written(e), fp.likeness(a, e), fp.likeness(a, b)))
    return out


@pytest.mark.parametrize("bucket_chars", [1 << 22, 1 << 12])
def test_report(spark, monkeypatch, bucket_chars):
    monkeypatch.setattr(fp, "BUCKET_CHARS", bucket_chars)
    monkeypatch.setattr(fp, "CHUNK", 3000)
    draw = random.Random(bucket_chars)
    rows = [(i * 3 - 50, draw.choice([prose(draw, draw.randint(0, 150)), "", "short", "same text in many rows"])) for i in range(150)]
    rows[40] = (rows[40][0], prose(draw, 5000))
    docs = spark.createDataFrame([(i, t or None, 1, "b", True) for i, t in draw.sample(rows, len(rows))], "doc_id long, text string, bucket int, hash string, tail boolean").repartition(7)
    got = sorted(tuple(r) for r in fp.edited_report(docs).collect())
    assert got == sorted(report(rows))
    prints = {r["doc_id"]: r["fingerprint"] for r in fp.fingerprints(docs).collect()}
    assert prints == {r[0]: r[3] for r in got}


def test_report_of_odd_rows(spark, odd_docs, no_docs):
    got = fp.edited_report(odd_docs).collect()
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_chars"]) for r in got) == sorted(
        (r["doc_id"] is not None, r["doc_id"] or 0, len(r["text"] or "")) for r in odd_docs.collect()
    )
    assert all(0 <= r[c] <= 1 for r in got for c in ("near_edited", "near_next"))
    # the row of no id is followed by the smallest id; copies of one row follow each other
    assert [r["near_next"] for r in got if r["doc_id"] == 5] in ([1.0, got_next(got)], [got_next(got), 1.0])
    assert fp.edited_report(no_docs).collect() == [] and fp.fingerprints(no_docs).collect() == []
    one = fp.edited_report(odd_docs.where("doc_id = 7")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0


def got_next(got):
    return next(r["near_next"] for r in got if r["doc_id"] == 5 and r["near_next"] != 1.0)
