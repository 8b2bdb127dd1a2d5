"""Document fingerprints as sketches scaled by a threshold.

A text's shingles are its runs of eight code points (a shorter text is one shingle). Its
sketch keeps the hash of every shingle that lies below a fixed share of the hash range,
so a long text keeps more than a short one and the part of a text that is in another can
be told however unequal they are. Where fewer than ``LEAST`` hashes lie below, the
``LEAST`` smallest are kept, so that short texts can be told apart too.

Either rule keeps what depends on the set of shingles alone: the sketch of two texts
together is cut from both sketches (``merged``). Two sketches are compared up to the
smaller of the values to which each is complete.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm import words as W

SHINGLE, SHARE, LEAST = 8, 1 / 32, 32
#: Greatest hash that is always kept.
CUT = np.uint64(int(SHARE * (1 << 64)) - 1)
ALL = np.uint64((1 << 64) - 1)
#: Code points sketched at a time (a longer text alone), and texts; code points of a bucket
#: of neighbours, the most buckets, and keys drawn a bucket to find where buckets begin. A bucket is read
#: as a stream, so its size bounds no memory.
CHUNK, CHUNK_ROWS, BUCKET_CHARS, MAX_BUCKETS, DRAWN = 1 << 20, 4096, 1 << 22, 1 << 16, 16


def _rolled(codes: np.ndarray, k: int) -> np.ndarray:
    """A number of each run of k codes, from those of its halves."""
    if k == 1:
        return codes.astype(np.uint64) + np.uint64(1)
    left = _rolled(codes, k // 2)
    right = left if k % 2 == 0 else _rolled(codes, k - k // 2)
    n = len(codes) - k + 1
    return left[:n] * np.uint64(pow(int(W.MIX_A), k - k // 2, 1 << 64)) + right[k // 2 : k // 2 + n]


def sketches(texts: list[str]) -> list[np.ndarray]:
    """Sketch of each text: its kept hashes, rising. An empty text keeps none."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    hashes = W.mix(_rolled(codes, SHINGLE)) if len(codes) >= SHINGLE else np.zeros(0, np.uint64)
    low = np.flatnonzero(hashes <= CUT)
    owner = np.searchsorted(ends, low, "right")
    whole = low + SHINGLE <= ends[owner] if len(low) else np.zeros(0, bool)
    low, owner = hashes[low[whole]], owner[whole]
    order = np.lexsort((low, owner))
    low, owner = low[order], owner[order]
    if len(low):
        new = np.concatenate([[True], (low[1:] != low[:-1]) | (owner[1:] != owner[:-1])])
        low, owner = low[new], owner[new]
    edges = np.searchsorted(owner, np.arange(len(texts) + 1))
    out = []
    for i, (size, end) in enumerate(zip(sizes.tolist(), ends.tolist(), strict=True)):
        kept = low[edges[i] : edges[i + 1]]
        if len(kept) < LEAST and size >= SHINGLE:
            kept = np.unique(hashes[end - size : end - SHINGLE + 1])[:LEAST]
        elif 0 < size < SHINGLE:
            kept = W.mix(_rolled(codes[end - size : end], size) ^ np.uint64(size))
        out.append(kept)
    return out


def _complete_to(sketch: np.ndarray) -> np.uint64:
    """Up to this value a sketch has all hashes of its text."""
    return ALL if len(sketch) < LEAST else max(CUT, sketch[-1])


def _compared(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    top = min(_complete_to(a), _complete_to(b))
    a, b = a[: np.searchsorted(a, top, "right")], b[: np.searchsorted(b, top, "right")]
    return a, b, len(np.intersect1d(a, b, assume_unique=True))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of the shingles of two texts that both have; 1 if both have none."""
    a, b, both = _compared(a, b)
    return both / (len(a) + len(b) - both) if len(a) or len(b) else 1.0


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of the shingles of the first text that the second has; 1 for a
    text without shingles, 0 where none of its hashes can be compared."""
    own, _, both = _compared(a, b)
    return both / len(own) if len(own) else float(len(a) == 0)


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sketch of the shingles of both texts together."""
    both = np.union1d(a, b)
    return both[: max(LEAST, int(np.searchsorted(both, CUT, "right")))]


def written(sketch: np.ndarray) -> str:
    """A sketch as text, in base 64."""
    return base64.b64encode(sketch.astype("<u8").tobytes()).decode()


def read(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), "<u8").astype(np.uint64)


def _chunks(rows: Iterator[tuple], text_at: int) -> Iterator[list[tuple]]:
    chunk, size = [], 0
    for row in rows:
        if chunk and (size + len(row[text_at]) > CHUNK or len(chunk) == CHUNK_ROWS):
            yield chunk
            chunk, size = [], 0
        chunk.append(row)
        size += len(row[text_at])
    if chunk:
        yield chunk


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, fingerprint) of every row of ``docs`` (doc_id, text); null texts
    count as empty. Equal texts have equal fingerprints. Other columns are not read."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in _chunks(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True), 1):
                ids, texts = zip(*chunk, strict=True)
                values = [pa.array(ids, batch.column(0).type), pa.array([len(t) for t in texts], pa.int64()), pa.array([written(s) for s in sketches(list(texts))], pa.string())]
                yield pa.RecordBatch.from_arrays(values, ["doc_id", "n_chars", "fingerprint"])

    return rows.mapInArrow(sketch, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_chars long, fingerprint string")


def _neighbours(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, text, bucket, tail) sorted by id within buckets, each of which ends
    with a copy (``tail``) of the row that comes next, as the last does of the first.

    Buckets begin at keys drawn by hash. A key is an id and a hash of the text, so rows
    of one id with different texts can be split over buckets.
    """
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("hash", F.xxhash64("text"))
    key = F.struct(F.col("doc_id").isNotNull(), F.coalesce("doc_id", F.lit(0)), F.col("hash"))
    rows, chars, least = keyed.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0)), F.min(key)).first()
    buckets = min(MAX_BUCKETS, 1 + chars // BUCKET_CHARS)
    starts: list[tuple] = []
    if buckets > 1:
        one_in = max(1, rows // (buckets * DRAWN))
        drawn = keyed.where(F.pmod(F.xxhash64("doc_id", "hash"), F.lit(one_in)) == 0).select(key.alias("key")).distinct()
        keys = sorted(tuple(r["key"]) for r in drawn.collect())
        starts = sorted({keys[len(keys) * i // buckets] for i in range(1, buckets)} - {tuple(least)}) if keys else []
    first = tuple(least) if least is not None else None

    @F.pandas_udf("array<long>")
    def places(known: pd.Series, doc_id: pd.Series, text_hash: pd.Series) -> pd.Series:
        out = []
        for k in zip(known.tolist(), doc_id.tolist(), text_hash.tolist(), strict=True):
            at = bisect_right(starts, k)
            own = [2 * at]
            if at and starts[at - 1] == k:
                own.append(2 * (at - 1) + 1)
            if k == first:
                own.append(2 * len(starts) + 1)
            out.append(own)
        return pd.Series(out)

    place = places(F.col("doc_id").isNotNull(), F.coalesce("doc_id", F.lit(0)), F.col("hash"))
    placed = keyed.withColumn("place", F.explode(place))
    placed = placed.select("doc_id", "text", "hash", F.floor(F.col("place") / 2).alias("bucket"), (F.col("place") % 2 == 1).alias("tail"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = placed.repartition(n, "bucket").sortWithinPartitions("bucket", "tail", F.asc_nulls_first("doc_id"), "hash")
    return ordered.select("doc_id", "text", "bucket", "tail")


def edited_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next) of every row of ``docs`` (doc_id, text).

    The edited text has the last quarter of its code points (rounded down) replaced by
    the first as many (or all) of the next document by id; the last is followed by the
    first, null ids come first, rows of one id follow each other by a hash of their text.
    near_edited and near_next estimate the likeness to the edited and to the next text.
    Null texts count as empty; two texts without shingles are alike (1). Rows that agree in id and
    text go through one task, as a stream. Other columns are not read; an empty table
    gives no rows.
    """

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True))
        last = None
        for chunk in _chunks(rows, 1):
            held = [(*row, s) for row, s in zip(chunk, sketches([row[1] for row in chunk]), strict=True)]
            held, last = ([last] if last else []) + held, held[-1]
            pairs = [(a, b) for a, b in zip(held, held[1:], strict=False) if a[2] == b[2] and not a[3]]
            edited = [a[1][: len(a[1]) - len(a[1]) // 4] + b[1][: len(a[1]) // 4] for a, b in pairs]
            marks = sketches(edited)
            columns = [
                pa.array([a[0] for a, _ in pairs], pa.int64()),
                pa.array([len(a[1]) for a, _ in pairs], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
                pa.array([written(a[4]) for a, _ in pairs], pa.string()),
                pa.array([written(m) for m in marks], pa.string()),
                pa.array([likeness(a[4], m) for (a, _), m in zip(pairs, marks, strict=True)], pa.float64()),
                pa.array([likeness(a[4], b[4]) for a, b in pairs], pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return _neighbours(docs).mapInArrow(report, schema)
