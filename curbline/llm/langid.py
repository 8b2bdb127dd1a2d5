"""Languages by a bidirectional gated recurrent network over bytes.

The network reads the bytes of a word (A-Z as a-z; long words in pieces) in both
directions, labels every byte with probabilities of the languages, and a document
gets the mean over all bytes of its whole text. It is trained here, in numpy, by
backpropagation through time, in one task on a bounded sample of labelled
documents; the weights (some 10^5 numbers) travel with the tasks.

Words repeat: a batch of texts labels each different word once and counts it as
often as it occurs, which changes nothing in the outcome.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbline.llm import words as W
from curbline.llm.samples import labelled_sample

HIDDEN, PIECE = 12, 24
#: Sampled documents, and word pieces of each language drawn from them for training.
SAMPLE_DOCS, PIECES_A_LANGUAGE = 3000, 12_000
EPOCHS, BATCH, RATE, SEED = 4, 256, 0.02, 11
#: Words labelled at a time.
LABELLED = 4096
UNKNOWN = "und"
WORDLIKE = re.compile(r"[^\W\d_]")


def has_letter(text: str | None) -> bool:
    return text is not None and any(m[0].isalpha() for m in WORDLIKE.finditer(text))


def pieces(body: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of every word piece of some texts."""
    starts, ends, before = W.words(body, bounds)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(before))
    parts = -(-(ends - starts) // PIECE)
    nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    first = np.repeat(starts, parts) + nth * PIECE
    return first, np.minimum(first + PIECE, np.repeat(ends, parts)), np.repeat(doc, parts)


def packed(body: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Pieces as rows of PIECE bytes."""
    at = np.minimum(starts[:, None] + np.arange(PIECE), len(body) - 1)
    return body[at]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Weights by name, float32: for each direction input (256, 3H) and recurrent
    (H, 3H) weights of update, reset and new state; output (2H, C) and bias (C)."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights

    @classmethod
    def drawn(cls, classes: int, hidden: int, draw: np.random.Generator) -> Network:
        shape = {"xf": (256, 3 * hidden), "xb": (256, 3 * hidden), "uf": (hidden, 3 * hidden), "ub": (hidden, 3 * hidden), "v": (2 * hidden, classes), "c": (classes,)}
        return cls({k: (draw.standard_normal(s) * (0.3 if len(s) > 1 else 0)).astype(np.float32) for k, s in shape.items()})

    def _read(self, rows: np.ndarray, active: np.ndarray, way: str, keep: bool) -> tuple[np.ndarray, list]:
        """States at every position, (PIECE, rows, H); rows are sorted by falling
        length, so at position t the first ``active[t]`` of them are at work."""
        x, u = self.w["x" + way], self.w["u" + way]
        size = u.shape[0]
        state = np.zeros((len(rows), size), np.float32)
        states = np.zeros((len(active), len(rows), size), np.float32)
        steps = []
        for t in range(len(active)) if way == "f" else range(len(active) - 1, -1, -1):
            n = active[t]
            old = state[:n]
            given, carried = x[rows[:n, t]], old @ u
            gates = sigmoid(given[:, : 2 * size] + carried[:, : 2 * size])
            update, reset = gates[:, :size], gates[:, size:]
            new = np.tanh(given[:, 2 * size :] + reset * carried[:, 2 * size :])
            if keep:
                steps.append((t, n, old.copy(), update, reset, new, carried[:, 2 * size :]))
            state[:n] = new + update * (old - new)
            states[t, :n] = state[:n]
        return states, steps

    def label(self, rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Sum of the position probabilities of each row; rows by falling length."""
        active = np.searchsorted(-sizes, -np.arange(sizes[0]), "left")
        forth, _ = self._read(rows, active, "f", False)
        back, _ = self._read(rows, active, "b", False)
        size, total = forth.shape[2], np.zeros((len(rows), len(self.w["c"])), np.float32)
        for t, n in enumerate(active):
            total[:n] += softmax(forth[t, :n] @ self.w["v"][:size] + back[t, :n] @ self.w["v"][size:] + self.w["c"])
        return total

    def gradients(self, rows: np.ndarray, sizes: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross entropy of all positions, by backpropagation through time."""
        active = np.searchsorted(-sizes, -np.arange(sizes[0]), "left")
        read = {way: self._read(rows, active, way, True) for way in "fb"}
        size, total = read["f"][0].shape[2], sizes.sum()
        out = {k: np.zeros_like(v) for k, v in self.w.items()}
        into = {way: np.zeros_like(read[way][0]) for way in "fb"}
        for t, n in enumerate(active):
            both = np.concatenate([read["f"][0][t, :n], read["b"][0][t, :n]], axis=1)
            error = softmax(both @ self.w["v"] + self.w["c"])
            error[np.arange(n), labels[:n]] -= 1
            error /= total
            out["v"] += both.T @ error
            out["c"] += error.sum(0)
            back = error @ self.w["v"].T
            into["f"][t, :n], into["b"][t, :n] = back[:, :size], back[:, size:]
        for way in "fb":
            u, later = self.w["u" + way], np.zeros((len(rows), size), np.float32)
            for t, n, old, update, reset, new, carried in reversed(read[way][1]):
                grad = into[way][t, :n] + later[:n]
                d_new = grad * (1 - update) * (1 - new**2)
                d_update = grad * (old - new) * update * (1 - update)
                d_reset = d_new * carried * reset * (1 - reset)
                given = np.concatenate([d_update, d_reset, d_new], axis=1)
                held = np.concatenate([d_update, d_reset, d_new * reset], axis=1)
                out["u" + way] += old.T @ held
                one_hot = (rows[:n, t, None] == np.arange(256)).astype(np.float32)
                out["x" + way] += one_hot.T @ given
                later[:n] = grad * update + held @ u.T
        return out


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def fit(texts: pa.Array, languages: list[str]) -> tuple[list[str], dict[str, np.ndarray]]:
    """Languages in order and trained weights (Adam, steps falling to zero)."""
    names = sorted(set(languages))
    body, bounds = W.text_bytes(texts)
    body = W.LOWER[body]
    starts, ends, doc = pieces(body, bounds - bounds[0])
    of = np.array([names.index(x) for x in languages])[doc]
    draw = np.random.default_rng(SEED)
    picked = [draw.choice(np.flatnonzero(of == c), PIECES_A_LANGUAGE) for c in range(len(names)) if (of == c).any()]
    net = Network.drawn(len(names), HIDDEN, draw)
    if not picked:
        return names, net.w
    picked = np.concatenate(picked)
    rows, sizes, labels = packed(body, starts[picked], ends[picked]), (ends - starts)[picked], of[picked]
    mean = {k: np.zeros_like(v) for k, v in net.w.items()}
    square = {k: np.zeros_like(v) for k, v in net.w.items()}
    steps = EPOCHS * -(-len(rows) // BATCH)
    step = 0
    for _ in range(EPOCHS):
        order = draw.permutation(len(rows))
        for at in range(0, len(rows), BATCH):
            part = order[at : at + BATCH]
            part = part[np.argsort(-sizes[part], kind="stable")]
            step += 1
            rate = RATE * (1 - step / (steps + 1))
            for k, g in net.gradients(rows[part], sizes[part], labels[part]).items():
                mean[k] += 0.1 * (g - mean[k])
                square[k] += 0.01 * (g * g - square[k])
                net.w[k] -= rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)
    return names, net.w


def train(docs: DataFrame, marked: DataFrame, sample_docs: int = SAMPLE_DOCS) -> tuple[list[str], dict[str, np.ndarray]] | None:
    """Model of the documents (doc_id, text) that ``marked`` (doc_id, label) names."""

    def fitted(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("draw", "ascending"), ("label", "ascending")])
        names, weights = fit(rows["text"].combine_chunks(), rows["label"].to_pylist())
        shapes = json.dumps({"names": names, "shapes": {k: v.shape for k, v in weights.items()}})
        return pa.table({"about": [shapes], "weights": pa.array([b"".join(v.tobytes() for v in weights.values())], pa.binary())})

    sample = labelled_sample(docs, marked, sample_docs)
    row = sample.groupBy("one").applyInArrow(fitted, "about string, weights binary").first()
    if row is None:
        return None
    about, flat, weights = json.loads(row["about"]), np.frombuffer(row["weights"], np.float32), {}
    for k, shape in about["shapes"].items():
        n = int(np.prod(shape))
        weights[k], flat = flat[:n].reshape(shape), flat[n:]
    return about["names"], weights


def document_probabilities(net: Network, body: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Mean position probabilities of each text; zeros for a text without bytes."""
    classes = len(net.w["c"])
    total = np.zeros((len(bounds) - 1, classes))
    body = W.LOWER[body]
    starts, ends, doc = pieces(body, bounds)
    if not len(starts):
        return total
    _, where, which = np.unique(W.word_hashes(body, starts, ends), return_index=True, return_inverse=True)
    sizes = (ends - starts)[where]
    order = np.argsort(-sizes, kind="stable")
    sums = np.zeros((len(where), classes), np.float32)
    for at in range(0, len(order), LABELLED):
        part = order[at : at + LABELLED]
        sums[part] = net.label(packed(body, starts[where[part]], ends[where[part]]), sizes[part])
    for c in range(classes):
        total[:, c] = np.bincount(doc, sums[which, c], minlength=len(total))
    return total / np.maximum(np.bincount(doc, ends - starts, minlength=len(total)), 1)[:, None]


def language_report(docs: DataFrame, held_out: Column, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row of ``docs`` (doc_id, text, lang).

    ``held_out`` is a boolean of doc_id; those rows teach nothing, nor do rows with
    a null id or language. ``lang_pred`` is a learned language and ``score`` its
    probability; ``und`` with score 0 for a text that is null or has no letter, and
    for all texts if nothing could be learned. Texts are read whole; ties go to the
    first language in order. Repeated rows are rows of their own. Other columns are
    not read.
    """
    marked = docs.where(~held_out).select("doc_id", F.col("lang").alias("label"))
    model = train(docs.select("doc_id", "text"), marked, sample_docs)
    picked = docs.select("doc_id", "text")

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, net = (model[0], Network(model[1])) if model else ([], None)
        for batch in batches:
            body, bounds = W.text_bytes(batch.column(1))
            known = [net is not None and has_letter(t) for t in batch.column(1).to_pylist()]
            best, score = np.zeros(batch.num_rows, int), np.zeros(batch.num_rows)
            for first, last in W.chunks(bounds, docs=1 << 20) if net else ():
                p = document_probabilities(net, body[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first])
                best[first:last], score[first:last] = p.argmax(1), p.max(1)
            said = [names[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
            columns = [batch.column(0), pa.array(said, pa.string()), pa.array(np.clip(np.where(known, score, 0.0), 0, 1))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score"])

    schema = T.StructType([picked.schema["doc_id"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    out = F.coalesce(held_out, F.lit(False)).alias("held_out")
    return picked.mapInArrow(predict, schema).select("doc_id", out, "lang_pred", "score")
