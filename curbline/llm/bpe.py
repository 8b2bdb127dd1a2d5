"""Byte-pair encoding by dynamic programming over prefixes, and decoding.

Every prefix of a text has exactly one last token in the encoding that merging by
rank gives. It is found without merging: among the vocabulary strings that end at
a position, the right one is that which may stand after the last token of the prefix
it leaves. They are matches of an Aho-Corasick automaton over the vocabulary, in place
of a suffix automaton: both give the same strings, and compiled code (pyahocorasick)
finds the former. Whether two tokens may stand side by
side is a property of the pair: merging across their border must not come before
the merges that made them. Back-pointers then give the ids.

The text is first cut as the vocabulary's pre-tokenizer does (byte-level pieces:
contractions, letters, numbers, other signs, white space) and at special tokens.
Pieces repeat, so a task keeps the ids of those met; the table is emptied when full.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Fixed value: the published pattern of byte-level pre-tokenization.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: The same for texts of Latin letters, which plain patterns cut faster: in texts
#: without COMMON's complement, LATIN holds all letters and 0-9 all numbers.
LATIN = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
COMMON = re.compile("[^\t-\r -~\u00a0-\u00b1\u00b4-\u00b8\u00ba\u00bb\u00bf-\u024f\u2010-\u2027\u2030-\u205e]")
LATIN_PIECES = re.compile(rf" ?[{LATIN}]+|'(?:[stmd]|re|ve|ll)| ?[0-9]+| ?[^\s{LATIN}0-9]+|\s+(?!\S)|\s+")
#: Pieces a task remembers, and the longest that it does (in characters).
KEPT_PIECES, KEPT_LENGTH = 250_000, 40
#: Pairs of tokens whose test a task remembers.
KEPT_PAIRS = 300_000
#: Texts longer than this (in characters) are cut piece by piece, not all at once.
CUT = 1 << 16


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class Encoder:
    """Encoder and decoder of a byte-level vocabulary file (merges, no normalizer)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            held = json.load(file)
        self.of_byte = byte_characters()
        vocab: dict[str, int] = held["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in held.get("added_tokens", [])}
        to_byte = {c: b for b, c in enumerate(self.of_byte)}
        self.bytes_of = [b""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for text, i in vocab.items():
            if text not in self.special:
                self.bytes_of[i] = bytes(to_byte[c] for c in text)
        for text, i in self.special.items():
            self.bytes_of[i] = text.encode()
        self.merged: dict[tuple[int, int], int] = {}
        self.rank: dict[int, int] = {}  # of the merge that made a token; bytes have none
        self.parts: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(held["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            whole, ids = vocab[a + b], (vocab[a], vocab[b])
            self.merged[ids] = whole
            if whole not in self.parts:
                self.parts[whole], self.rank[whole] = ids, rank
        self.automaton = ahocorasick.Automaton()
        for text, i in vocab.items():
            if text not in self.special and (len(text) == 1 or i in self.parts):
                self.automaton.add_word(text, (i, len(text)))
        self.automaton.make_automaton()
        self.beside: dict[tuple[int, int], bool] = {}
        self.cut = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))) if self.special else None
        self.pieces = _Pieces(self)

    def may_follow(self, left: int, right: int) -> bool:
        """Whether merging by rank keeps these two tokens apart, side by side.

        Undo merges from the latest on, of whichever token has it: at each moment the
        tokens that touch at the border must not merge before the one just undone.
        """
        known = self.beside.get((left, right))
        if known is not None:
            return known
        pair, limit, ok = (left, right), 1 << 60, True
        rank, parts = self.rank, self.parts
        while True:
            whole = self.merged.get((left, right))
            if whole is not None and rank[whole] < limit:
                ok = False
                break
            a, b = rank.get(left, -1), rank.get(right, -1)
            if a < 0 and b < 0:
                break
            # of equal merges the left one was made first, so it is undone last
            if a > b:
                limit, left = a, parts[left][1]
            else:
                limit, right = b + 1, parts[right][0]
        if len(self.beside) >= KEPT_PAIRS:
            self.beside.clear()
        self.beside[pair] = ok
        return ok

    def piece(self, text: str) -> bytes:
        """Ids of one piece as little-endian 32-bit integers."""
        letters = "".join(map(self.of_byte.__getitem__, text.encode("utf-8", "replace")))
        last: list[int] = [-1] * (len(letters) + 1)
        for end, (token, size) in self.automaton.iter(letters):
            at = end + 1 - size
            if last[end + 1] < 0 and (at == 0 or (last[at] >= 0 and self.may_follow(last[at], token))):
                last[end + 1] = token
        ids, at = [], len(letters)
        while at:
            ids.append(last[at])
            at -= len(self.bytes_of[last[at]])
        return np.array(ids[::-1], "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian 32-bit integers, special tokens found
        in it included."""
        if self.cut is None:
            return self._plain(text)
        out, at = [], 0
        for m in self.cut.finditer(text):
            out += [self._plain(text[at : m.start()]), self.special[m[0]].to_bytes(4, "little")]
            at = m.end()
        return b"".join([*out, self._plain(text[at:])]) if at else self._plain(text)

    def _plain(self, text: str) -> bytes:
        get = self.pieces.__getitem__
        pieces = PIECES if COMMON.search(text) else LATIN_PIECES
        if len(text) <= CUT:
            return b"".join(map(get, pieces.findall(text)))
        return b"".join(get(m[0]) for m in pieces.finditer(text))

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


class _Pieces(dict):
    def __init__(self, encoder: Encoder):
        self.encoder = encoder

    def __missing__(self, text: str) -> bytes:
        ids = self.encoder.piece(text)
        if len(text) <= KEPT_LENGTH:
            if len(self) >= KEPT_PIECES:
                self.clear()
            self[text] = ids
        return ids


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder a worker process and file."""
    return Encoder(path)


def encode_column(docs: DataFrame, path: str, text_column: str = "text", ids: bool = True, digests: bool = False) -> DataFrame:
    """``docs`` with columns of the ids of every whole text (null: empty).

    ``path`` is a vocabulary file that every machine has. Columns added: n_tokens
    long; with ``ids`` ids array<int>; with ``digests`` ids_sha256 (of the ids as
    little-endian 32-bit integers) and decoded_sha256 (of the text decoded from
    them). They replace columns of those names. Rows are encoded on their own, so
    ties, repeated rows, null ids and empty tables need no rule.
    """
    added = ["n_tokens", *["ids"] * ids, *["ids_sha256", "decoded_sha256"] * digests]
    docs = docs.drop(*[c for c in added if c != text_column])
    at = docs.columns.index(text_column)
    kinds = {"n_tokens": T.LongType(), "ids": T.ArrayType(T.IntegerType())}
    fields = [T.StructField(c, kinds.get(c, T.StringType())) for c in added]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            packed = [bpe.encode(t or "") for t in batch.column(at).to_pylist()]
            columns = [*batch.columns, pa.array([len(p) // 4 for p in packed], pa.int64())]
            if ids:
                flat = pa.array(np.frombuffer(b"".join(packed), "<i4"))
                ends = np.cumsum([0, *[len(p) // 4 for p in packed]], dtype=np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(ends), flat))
            if digests:
                columns.append(pa.array([hashlib.sha256(p).hexdigest() for p in packed]))
                columns.append(pa.array([hashlib.sha256(bpe.decode(p).encode()).hexdigest() for p in packed]))
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, *added])

    return docs.mapInArrow(encode, T.StructType([*docs.schema.fields, *fields]))
