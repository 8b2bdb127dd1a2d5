"""op8: against the tokenizers library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from curbline.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    held = Tokenizer.from_file(PATH)
    held.no_truncation()
    held.no_padding()
    return held


def agrees(library, texts):
    own = bpe.encoder(PATH)
    for text in texts:
        want = library.encode(text, add_special_tokens=False).ids
        packed = own.encode(text)
        assert np.frombuffer(packed, "<u4").tolist() == want, text[:80]
        assert own.decode(packed) == library.decode(want, skip_special_tokens=False) == text


def test_texts_of_the_tables(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    agrees(library, [r.text for r in docs if r.text is not None])


def test_random_and_odd_texts(library):
    draw = random.Random(4)
    alphabet = "abcdefgh  \n\t'’éß²½٠ǅ漢字\U0001f600́ ​\x1c\x850123.,!?-_<|>"
    texts = ["".join(draw.choice(alphabet) for _ in range(draw.randint(0, 120))) for _ in range(1500)]
    texts += ["a" * n for n in range(0, 150)] + [" " * n + "x " * 2 for n in range(30)] + ["ab" * 3000, "don't I'LL we've"]
    texts += ["<|endoftext|>", "x <|endoftext|><|endoftext|> y", "<|endoftext", "1234567890" * 30]
    agrees(library, texts)


def test_long_text_is_cut_piece_by_piece(library, monkeypatch):
    monkeypatch.setattr(bpe, "CUT", 10)
    agrees(library, ["the quick brown fox 漢 jumps over it, 12 times  "] * 2)


def test_pieces_are_forgotten_not_wrong(library, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_PIECES", 3)
    agrees(library, ["some words come again and some words do not come again"] * 2)


def test_columns(odd_docs, no_docs):
    out = bpe.encode_column(odd_docs, PATH, digests=True)
    assert out.columns == [*odd_docs.columns, "n_tokens", "ids", "ids_sha256", "decoded_sha256"]
    rows = out.collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert r.n_tokens == len(r.ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(r.ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    assert bpe.encode_column(no_docs, PATH).count() == 0
