"""Quality scores by Naive Bayes support vectors (Wang and Manning, 2012).

Features are indicators of n-grams, hashed to a fixed number of slots. Each is
scaled by the class log-count ratio of Naive Bayes; a linear hinge-loss model is
then fitted to the scaled indicators by dual coordinate descent. A logistic curve
fitted to cross-validated margins turns margins into scores from 0 to 1.

n-grams of a document: bytes of length 1 to 3, pairs of neighbouring word shapes
(case, digits and punctuation of a word), and how many sixteenths of its word pairs
are a word repeated. Scaled indicators have length 1; what a text shows too little
of to judge it by is made up from the share of labels, so short texts lean to the
common label.

The model is fitted in one task on a bounded sample of the labelled rows
(``sample_docs``, those of smallest hash); every whole text is scored. Weights
are 2^17 numbers and travel with the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from curbline.llm import words as W
from curbline.llm.samples import labelled_sample

SLOTS_LOG2 = 16
SLOTS = 1 << SLOTS_LOG2
SAMPLE_DOCS = 6000
ACCEPT = 0.7
#: Value of the constant feature; folds for the margins that the curve is fitted to.
BIAS, FOLDS = 1.0, 4
#: Share of the typical norm of a text's indicators that the prior weighs as much as.
EVIDENCE = 0.25
#: Documents whose indicators are held at a time (64 rows of 2^16 flags).
SCORED_DOCS = 64

#: Byte classes for word shapes: 1 lower, 2 upper, 4 digit, 8 other ASCII, 16 not ASCII.
BYTE_CLASS = np.full(256, 8, np.uint8)
BYTE_CLASS[97:123], BYTE_CLASS[65:91], BYTE_CLASS[48:58], BYTE_CLASS[128:] = 1, 2, 4, 16


def _slot(values: np.ndarray, kind: int) -> np.ndarray:
    values = (values.astype(np.uint32) + np.uint32(kind * 0x3C6EF372 & 0xFFFFFFFF)) * np.uint32(0x9E3779B1)
    values ^= values >> np.uint32(15)
    return (values * np.uint32(0x85EBCA77)) >> np.uint32(32 - SLOTS_LOG2)


def indicators(body: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the n-grams of some documents and the document of each; may repeat."""
    sizes = np.diff(bounds)
    doc = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    wide = body.astype(np.uint32)
    slots, owner = [_slot(wide, 1)], [doc]
    gram = wide
    for n in (2, 3):
        if len(body) < n:
            break
        gram = (gram[:-1] << np.uint32(8)) | wide[n - 1 :]
        inside = doc[: len(gram)] == doc[n - 1 :]
        slots.append(_slot(gram[inside], n))
        owner.append(doc[: len(gram)][inside])
    starts, ends, before = W.words(body, bounds)
    if len(starts):
        word_doc = np.repeat(np.arange(len(sizes), dtype=np.int32), np.diff(before))
        same_doc = word_doc[1:] == word_doc[:-1]
        h = W.word_hashes(body, starts, ends)
        again = same_doc & (h[1:] == h[:-1])
        many = np.flatnonzero(np.diff(before) > 1)
        share = 16 * np.bincount(word_doc[1:][again], minlength=len(sizes))[many] // np.diff(before)[many]
        slots.append(_slot(share, 4))
        owner.append(many.astype(np.int32))
        shape = np.bitwise_or.reduceat(BYTE_CLASS[body] & ~(W.SEPARATOR[body] * np.uint8(255)), starts).astype(np.uint32)
        shape = (shape << np.uint32(1)) | (ends - starts == 1)
        pair = ((shape[:-1] << np.uint32(8)) | shape[1:])[same_doc]
        slots.append(_slot(pair, 5))
        owner.append(word_doc[1:][same_doc])
    return np.concatenate(slots), np.concatenate(owner)


def fit(texts: pa.Array, labels: np.ndarray, epochs: int = 20, cost: float = 10.0, smooth: float = 1.0) -> tuple[np.ndarray, list[float]]:
    """Weights and squared ratios per slot; bias and what ``scores`` needs."""
    body, bounds = W.text_bytes(texts)
    rows = []
    for first, last in W.chunks(bounds):
        start = bounds[first]
        slot, doc = indicators(body[start : bounds[last]], bounds[first : last + 1] - start)
        key = np.unique(doc.astype(np.int64) << SLOTS_LOG2 | slot)
        rows += np.split((key & (SLOTS - 1)).astype(np.int32), np.searchsorted(key, np.arange(1, last - first) << SLOTS_LOG2))
    sign = np.where(labels > 0, 1.0, -1.0)
    if len(set(sign)) < 2:  # one class only: every score is its share
        share = (np.sum(labels > 0) + 0.5) / (len(labels) + 1)
        return np.zeros(2 * SLOTS), [0.0, 0.0, 0.0, 1.0, float(np.log(share / (1 - share)))]
    everything, margin, known = np.arange(len(rows)), np.zeros(len(rows)), np.zeros(len(rows), bool)
    for fold in range(FOLDS):  # margins of rows that the fit has not seen
        held = everything % FOLDS == fold
        if len(set(sign[~held])) == 2 and held.any():
            weights, bias = _fit_weights(rows, sign, everything[~held], epochs, cost, smooth)
            margin[held] = [_margin(weights, bias, rows[i])[0] for i in np.flatnonzero(held)]
            known |= held
    slope, offset = _logistic(margin[known], (sign[known] > 0).astype(float)) if known.any() else (1.0, 0.0)
    weights, bias = _fit_weights(rows, sign, everything, epochs, cost, smooth)
    typical = EVIDENCE * float(np.median([_margin(weights, bias, r)[1] for r in rows]))
    n1, n0 = np.sum(sign > 0), np.sum(sign < 0)
    return weights, [bias, slope, offset, typical, float(np.log(n1 / n0))]


def scores(margins: np.ndarray, norms: np.ndarray, slope: float, offset: float, typical: float, prior: float) -> np.ndarray:
    """0 to 1: the curve's value, weighed against the prior by the norm of a text's
    scaled indicators before they were brought to length 1."""
    weight = norms / (norms + typical + 1e-12)
    return 1 / (1 + np.exp(-np.clip(weight * (slope * margins + offset) + (1 - weight) * prior, -40, 40)))


def _fit_weights(rows: list, sign: np.ndarray, use: np.ndarray, epochs: int, cost: float, smooth: float) -> tuple[np.ndarray, float]:
    """Weights and bias by dual coordinate descent over indicators scaled by their
    log-count ratios. The bias is a feature of value BIAS in every row."""
    counts = {s: np.bincount(np.concatenate([rows[i] for i in use if sign[i] == s]), minlength=SLOTS) + smooth for s in (1.0, -1.0)}
    ratio = np.log(counts[1.0] / counts[1.0].sum()) - np.log(counts[-1.0] / counts[-1.0].sum())
    weight, bias, dual = np.zeros(SLOTS), 0.0, np.zeros(len(rows))
    values = {i: ratio[rows[i]] / (np.linalg.norm(ratio[rows[i]]) + 1e-12) for i in use}
    square = {i: v @ v + BIAS**2 for i, v in values.items()}
    draw = np.random.default_rng(7)
    for _ in range(epochs):
        worst = 0.0
        for i in draw.permutation(use):
            gradient = sign[i] * (weight[rows[i]] @ values[i] + BIAS * bias) - 1
            new = min(max(dual[i] - gradient / square[i], 0.0), cost)
            if new != dual[i]:
                step = (new - dual[i]) * sign[i]
                weight[rows[i]] += step * values[i]
                bias += step * BIAS
                worst = max(worst, abs(new - dual[i]) * square[i])
                dual[i] = new
        if worst < 0.01:
            break
    return np.concatenate([weight * ratio, ratio**2]), bias * BIAS


def _margin(weights: np.ndarray, bias: float, row: np.ndarray) -> tuple[float, float]:
    """Margin of a text with these slots, and the norm of its scaled indicators."""
    norm = np.sqrt(weights[SLOTS:][row].sum())
    return weights[:SLOTS][row].sum() / (norm + 1e-12) + bias, norm


def _logistic(margin: np.ndarray, positive: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by damped Newton steps. Targets are
    drawn in a little, so a separable sample has a finite slope."""
    n1, n0 = positive.sum(), (1 - positive).sum()
    target = np.where(positive > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    slope, offset = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(slope * margin + offset, -40, 40)))
        error, spread = p - target, p * (1 - p) + 1e-9
        g = np.array([error @ margin + 1e-3 * (slope - 1), error.sum()])
        h = np.array([[spread @ margin**2 + 1e-3, spread @ margin], [spread @ margin, spread.sum() + 1e-6]])
        step = np.clip(np.linalg.solve(h, g), -1, 1)
        slope, offset = slope - step[0], offset - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(max(slope, 0.0)), float(offset)


def train(docs: DataFrame, taught: DataFrame, sample_docs: int = SAMPLE_DOCS) -> np.ndarray | None:
    """Model of the documents (doc_id, text) that ``taught`` (doc_id, label) marks:
    weights and squared ratios of the slots, then five numbers; None without any. The fit is one task
    over a sample of at most ``sample_docs`` rows, whose texts are read whole."""
    marked = taught.select("doc_id", F.col("label").cast("int").alias("label"))
    sample = labelled_sample(docs, marked, sample_docs)

    def fitted(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("draw", "ascending"), ("label", "ascending")])
        weights, rest = fit(rows["text"].combine_chunks(), rows["label"].to_numpy())
        return pa.table({"model": pa.array([np.concatenate([weights, rest]).tobytes()], pa.binary())})

    row = sample.groupBy("one").applyInArrow(fitted, "model binary").first()
    return None if row is None else np.frombuffer(row["model"], np.float64)


def with_scores(docs: DataFrame, model: np.ndarray | None, text_column: str = "text", name: str = "score") -> DataFrame:
    """``docs`` and the score of each whole text in column ``name`` (0.5 without a model)."""
    at = docs.columns.index(text_column)
    weights = None if model is None else model[: 2 * SLOTS].astype(np.float32)
    bias, *curve = (0.0, 0.0, 0.0, 1.0, 0.0) if model is None else model[2 * SLOTS :].tolist()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.zeros(SCORED_DOCS * SLOTS, bool)
        for batch in batches:
            body, bounds = W.text_bytes(batch.column(at))
            found = np.zeros((batch.num_rows, 2))
            for first, last in W.chunks(bounds, SCORED_DOCS) if weights is not None else ():
                start = bounds[first]
                slot, doc = indicators(body[start : bounds[last]], bounds[first : last + 1] - start)
                flags[doc.astype(np.int64) << SLOTS_LOG2 | slot] = True
                view = flags[: (last - first) * SLOTS].reshape(last - first, SLOTS)
                found[first:last] = [_margin(weights, bias, np.flatnonzero(row)) for row in view]
                view[:] = False
            scored = scores(found[:, 0], found[:, 1], *curve)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scored)], [*batch.schema.names, name])

    return docs.mapInArrow(score, StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def quality_scores(docs: DataFrame, labels: DataFrame, held_out: Column, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``.

    ``docs`` has doc_id and text, ``labels`` doc_id and quality; ``held_out`` is a
    boolean of doc_id whose rows teach nothing. Null and empty texts are scored like
    any text without n-grams. Null ids are never held out and teach nothing. A label
    that is null teaches nothing; repeated rows teach as often as they occur. Without
    any label every score is 0.5. Other columns are not read.
    """
    docs = docs.select("doc_id", "text")
    model = train(docs, labels.where(~held_out).select("doc_id", F.col("quality").alias("label")), sample_docs)
    scored = with_scores(docs, model)
    out = F.coalesce(held_out, F.lit(False)).alias("held_out")
    return scored.select("doc_id", out, "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))


def crc_remainder(column: str, of: int) -> Column:
    """crc32 of an id as text, modulo ``of``; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % of
