"""op13: against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter
from itertools import combinations

import pytest

from curbline.llm import spelling


def near(u, v):
    """Exactly one inserted, deleted or replaced code point."""
    if len(u) < len(v):
        u, v = v, u
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v, strict=True)) == 1
    return len(u) - len(v) == 1 and any(u[:i] + u[i + 1 :] == v for i in range(len(u)))


def brute(counts):
    ways = {w: [] for w in counts}
    for u, v in combinations(counts, 2):
        if near(u, v):
            ways[u].append(v)
            ways[v].append(u)
    form = {}
    for w, some in ways.items():
        best = min(some, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(ways[w]), counts.get(form[w])))
    return sorted(out, key=lambda r: r[0])


def words(seed, n, letters, least=1, most=9):
    draw = random.Random(seed)
    return {"".join(draw.choice(letters) for _ in range(draw.randint(least, most))): draw.choice([1, 2, 3, 7, 50, 50]) for _ in range(n)}


def test_composition():
    for seed in range(60):
        vocabulary = list(words(seed, 40, "abé", 0, 6))
        found = spelling.Acceptor(vocabulary).one_edit(99)
        assert sorted(map(sorted, found)) == sorted(map(sorted, (p for p in combinations(vocabulary, 2) if near(*p))))


def test_minimal_acceptor():
    """As many states as there are different sets of strings ahead of a beginning."""
    vocabulary = ["tapping", "tapped", "taping", "taped", "rapped", "rapping", *words(2, 100, "ab", 0, 6)]
    acceptor = spelling.Acceptor(vocabulary)
    assert sorted(acceptor.ahead(acceptor.initial)) == sorted(set(vocabulary))
    begun = {w[:i] for w in vocabulary for i in range(len(w) + 1)}
    assert len(acceptor.arcs) == len({frozenset(w[len(b) :] for w in vocabulary if w.startswith(b)) for b in begun})


@pytest.mark.parametrize(("part_words", "span"), [(20_000, 64), (8, 64), (2, 2)])
def test_groups(spark, part_words, span):
    counts = words(part_words, 500, "abc", 1, 6) | words(9, 80, "xyzéÿ", 4, 8)
    counts |= {w: 3 for w in ("thé" + "o" * 70, "thé" + "o" * 71, "the" + "o" * 70)}
    vocabulary = spark.createDataFrame([(w, n, 1, "x") for w, n in counts.items()], "word string, n int, size int, before string")
    got = spelling.spelling_groups(vocabulary, part_words=part_words, span=span).collect()
    assert sorted((tuple(r) for r in got), key=lambda r: r[0]) == brute(counts)


def test_chains_of_forms(spark):
    chain = {"aaaaa" + "b" * i: 2**i for i in range(12)}
    got = spelling.spelling_groups(spark.createDataFrame(list(chain.items()), "word string, n long"))
    assert {r["root"] for r in got.collect()} == {"aaaaa" + "b" * 11}


def counted(rows, noise):
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if noise and h % noise == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}


@pytest.mark.parametrize("noise", [0, 2, 97])
def test_counted_words(spark, monkeypatch, odd_docs, no_docs, noise):
    monkeypatch.setattr(spelling, "COUNTED", 20)
    draw = random.Random(noise)
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    rows += [(i, " ".join(draw.choice(["Straße", "ÉCOLE", "École", "naïve", "don't", "ab-cdefg", "Ÿpsilon", "plain1words", "×÷multiply"]) for _ in range(40))) for i in range(30)]
    docs = spark.createDataFrame([(*r, 1, "w") for r in rows], "doc_id long, text string, n int, word string").repartition(3)
    got = {r["word"]: r["n"] for r in spelling.counted_words(docs, noise=noise).collect()}
    assert got == counted(rows, noise)
    assert spelling.spelling_groups(spelling.counted_words(no_docs)).collect() == []
