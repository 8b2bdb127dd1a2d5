"""Whole texts as numpy arrays: words and shingles of many documents at once.

Texts stay the UTF-8 bytes of an Arrow column; separators are ASCII, so bytes are
enough. A text is never cut: a chunk holds whole documents, and a document larger
than a chunk is a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Bytes that separate words: space and tab to carriage return.
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
#: A-Z to a-z, all other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Keeps the first n bytes of a little-endian 8-byte load.
FIRST_BYTES = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)

#: Odd multipliers of the mixing functions (any would do).
MIX_A, MIX_B, MIX_C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))
CHUNK_DOCS, CHUNK_BYTES, LONG_WORD = 256, 1 << 21, 512


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; one to one."""
    h = h ^ (h >> np.uint64(32))
    h = h * MIX_A
    h ^= h >> np.uint64(29)
    h *= MIX_C
    return h ^ (h >> np.uint64(32))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the len + 1 offsets into them; null is empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64, len(column) + 1, 8 * column.offset) if len(column) else np.zeros(1, np.int64)
    body = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return body, bounds


def chunks(bounds: np.ndarray, docs: int = CHUNK_DOCS, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole documents, of bounded number and (but for one large one) bytes."""
    first, n = 0, len(bounds) - 1
    while first < n:
        last = int(np.searchsorted(bounds, bounds[first] + size, "right")) - 1
        last = min(max(last, first + 1), first + docs, n)
        yield first, last
        first = last


def words(body: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and per document the number of words before it
    (len + 1 values). ``bounds`` begins at 0 and ends at the length of ``body``."""
    if not len(body):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
    inside = ~SEPARATOR[body]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edges = bounds[(bounds > 0) & (bounds < len(body))]
    opens[edges] |= inside[edges]
    closes[edges - 1] |= inside[edges - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def word_hashes(body: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, eight bytes at a step."""
    padded = np.concatenate([body, np.zeros(8, np.uint8)])
    loads = np.ndarray((len(body) + 1,), "<u8", padded, strides=(1,))
    sizes = ends - starts
    hashes = mix((loads[starts] & FIRST_BYTES[np.minimum(sizes, 8)]) ^ (sizes.astype(np.uint64) * MIX_B))
    at, rest = 8, np.flatnonzero((sizes > 8) & (sizes <= LONG_WORD))
    while len(rest):
        more = loads[starts[rest] + at] & FIRST_BYTES[np.minimum(sizes[rest] - at, 8)]
        hashes[rest] = mix(hashes[rest] * MIX_A + more)
        at += 8
        rest = rest[sizes[rest] > at]
    for i in np.flatnonzero(sizes > LONG_WORD):
        hashes[i] = xxhash.xxh64_intdigest(body[starts[i] : ends[i]].tobytes())
    return hashes


def shingle_sets(body: np.ndarray, bounds: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The distinct k-word shingles of each of at most 256 documents as 56-bit hashes
    in ascending order, one document after the other, and each one's number.

    A-Z count as a-z. A document with fewer words has its whole sequence as one
    shingle; one without words has none.
    """
    assert len(bounds) - 1 <= CHUNK_DOCS
    body = LOWER[body]
    starts, ends, before = words(body, bounds)
    n_words, doc_of = np.diff(before), None
    h = word_hashes(body, starts, ends)
    doc_of = np.repeat(np.arange(len(n_words)), n_words)
    found, owner = [], []
    if len(h) >= k:
        rolled = h[: len(h) - k + 1].copy()
        for j in range(1, k):
            rolled = rolled * MIX_B + h[j : len(h) - k + 1 + j]
        whole = doc_of[: len(rolled)] == doc_of[k - 1 :]
        found.append(mix(rolled[whole]))
        owner.append(doc_of[: len(rolled)][whole])
    for n in range(1, k):
        short = np.flatnonzero(n_words == n)
        rolled = np.full(len(short), n, np.uint64)
        for j in range(n):
            rolled = rolled * MIX_B + h[before[short] + j]
        found.append(mix(rolled ^ MIX_A))
        owner.append(short)
    keys = (np.concatenate(owner).astype(np.uint64) << np.uint64(56)) | (np.concatenate(found) >> np.uint64(8))
    keys.sort()
    if len(keys):
        keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
    sizes = np.bincount((keys >> np.uint64(56)).astype(np.int64), minlength=len(n_words))
    return keys & np.uint64((1 << 56) - 1), sizes


def set_fingerprints(hashes: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """16 bytes for each set of hashes, equal for equal sets; b"" for an empty set."""
    out = [b""] * len(sizes)
    filled = np.flatnonzero(sizes)
    if len(filled):
        first = (np.cumsum(sizes) - sizes)[filled]
        pair = np.stack([np.add.reduceat(mix(hashes + c), first) for c in (MIX_B, MIX_C)], axis=1)
        packed = mix(pair).tobytes()
        for at, i in enumerate(filled):
            out[i] = packed[16 * at : 16 * at + 16]
    return out
