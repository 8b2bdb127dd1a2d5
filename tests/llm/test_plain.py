"""op5 and op9 against plain loops: the optimum of the hinge loss, margins, and labels of bytes."""

import re

import numpy as np
import pyarrow as pa
import pytest

from curbline.llm import langid, quality
from curbline.llm import words as W


def test_descent_reaches_the_optimum():
    draw = np.random.default_rng(3)
    n, cost = 40, 2.0
    sign = np.where(draw.random(n) < 0.4, 1.0, -1.0)
    sign[:2] = 1, -1
    # rows of 20 of 60 slots, with some that one class has more often
    rows = [np.sort(draw.choice(60, 20, replace=False, p=(w := np.where(np.arange(60) % 2 == (s > 0), 2.0, 1.0)) / w.sum())) for s in sign]
    fitted, bias = quality._fit_weights(rows, sign, np.arange(n), 2000, cost, 1.0)

    counts = {s: np.ones(quality.SLOTS) for s in (1, -1)}
    for row, s in zip(rows, sign):
        for slot in row:
            counts[int(s)][slot] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[-1] / counts[-1].sum())
    x = np.zeros((n, 61))
    for i, row in enumerate(rows):
        x[i, row] = ratio[row] / np.linalg.norm(ratio[row])
        x[i, 60] = quality.BIAS
    # the dual problem by plain projected ascent
    q = (x @ x.T) * np.outer(sign, sign)
    dual, step = np.zeros(n), 1 / np.linalg.eigvalsh(q).max()
    for _ in range(50_000):
        dual = np.clip(dual + step * (1 - q @ dual), 0, cost)
    best = dual.sum() - 0.5 * dual @ q @ dual

    weight = np.append(np.divide(fitted[:60], ratio[:60], out=np.zeros(60), where=ratio[:60] != 0), bias / quality.BIAS)
    loss = 0.5 * weight @ weight + cost * np.maximum(0, 1 - sign * (x @ weight)).sum()
    assert best * (1 - 1e-6) <= loss <= best * 1.01
    assert weight == pytest.approx((dual * sign) @ x, abs=0.05)


def test_scores_are_those_of_a_plain_loop(spark):
    texts = [f"good words {i} here and there, number {i * i}" for i in range(20)] + [f"BUY {i}!!! now now now $$$" for i in range(15)]
    labels = np.array([1] * 20 + [0] * 15)
    weights, (bias, slope, offset, typical, prior) = quality.fit(pa.array(texts), labels)
    asked = [*texts, "", None, "é", "good " * 3000, "words of BUY", "words of BUY"]
    made = spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string").repartition(3)
    model = np.concatenate([weights, [bias, slope, offset, typical, prior]])
    got = {r.doc_id: r.score for r in quality.with_scores(made, model).collect()}
    for i, text in enumerate(asked):
        body = np.frombuffer((text or "").encode(), np.uint8)
        slots, _ = quality.indicators(body, np.array([0, len(body)]))
        margin = square = 0.0
        for slot in set(slots.tolist()):
            margin += float(weights[slot])
            square += float(weights[quality.SLOTS + slot])
        norm = square**0.5
        share = norm / (norm + typical + 1e-12)
        power = share * (slope * (margin / (norm + 1e-12) + bias) + offset) + (1 - share) * prior
        assert got[i] == pytest.approx(1 / (1 + np.exp(-power)), abs=1e-4)
    assert len(got) == len(asked) and got[len(asked) - 1] == got[len(asked) - 2]


def _states(net, piece: bytes, way: str) -> list:
    """States of one gated recurrent reader over the bytes of a piece."""
    u, size = net.w["u" + way].astype(float), net.w["u" + way].shape[0]
    state, states = np.zeros(size), []
    for byte in piece if way == "f" else piece[::-1]:
        given = net.w["x" + way][byte].astype(float)
        carried = state @ u
        update = 1 / (1 + np.exp(-(given[:size] + carried[:size])))
        reset = 1 / (1 + np.exp(-(given[size : 2 * size] + carried[size : 2 * size])))
        new = np.tanh(given[2 * size :] + reset * carried[2 * size :])
        state = (1 - update) * new + update * state
        states.append(state)
    return states if way == "f" else states[::-1]


def test_document_probabilities_are_those_of_a_plain_loop():
    net = langid.Network.drawn(4, 6, np.random.default_rng(5))
    texts = ["One two TWO two", "", " \n ", "x" * 60 + " y", "été größer \U0001f600 one", "two One", None, "a"]
    body, bounds = W.text_bytes(pa.array(texts))
    got = langid.document_probabilities(net, body, bounds)
    for text, found in zip(texts, got):
        total, count = np.zeros(4), 0
        for word in re.findall(rb"[^ \t-\r]+", (text or "").encode()):
            word = bytes(b + 32 if 65 <= b <= 90 else b for b in word)
            for at in range(0, len(word), langid.PIECE):
                piece = word[at : at + langid.PIECE]
                for forth, back in zip(_states(net, piece, "f"), _states(net, piece, "b")):
                    power = np.exp(np.concatenate([forth, back]) @ net.w["v"].astype(float) + net.w["c"])
                    total, count = total + power / power.sum(), count + 1
        assert found == pytest.approx(total / max(count, 1), abs=1e-5)
