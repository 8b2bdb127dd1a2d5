"""op7: against brute force over all pairs."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from curbline.llm import jaccard, words
from curbline.llm.components import components


def shingles(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^ \t-\r]+", lower)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    """[(id, n_shingles, component)] of (id, text) rows."""
    sets = [shingles(t) for _, t in rows]
    part = list(range(len(rows)))

    def root(x):
        while part[x] != x:
            x = part[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                    part[root(i)] = root(j)
    least = defaultdict(list)
    for i, (name, _) in enumerate(rows):
        if name is not None:
            least[root(i)].append(name)
    return [(name, len(sets[i]), min(least[root(i)], default=None)) for i, (name, _) in enumerate(rows)]


def near_groups(seed, groups=12, copies=14):
    """Chains and stars of edited copies, with a passage that all documents share."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 12)))
    passage = [word() for _ in range(20)]
    rows = []
    for _ in range(groups):
        base = [word() for _ in range(draw.randint(5, 120))]
        for _ in range(draw.randint(1, copies)):
            text = list(base)
            for _ in range(draw.randint(0, 3)):
                text[draw.randrange(len(text))] = word()
            if draw.random() < 0.3:
                base = text
            rows.append((len(rows) * 3 % 1009, " ".join(passage + text if draw.random() < 0.5 else text)))
    return rows


@pytest.mark.parametrize(("seed", "region_docs"), [(1, 2048), (2, 6), (3, 3)])
def test_equals_brute_force(spark, seed, region_docs):
    rows = near_groups(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = Counter(tuple(r) for r in jaccard.near_duplicates(docs, region_docs=region_docs).collect())
    assert got == Counter(brute(rows))


def test_odd_documents(odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = Counter(tuple(r) for r in jaccard.near_duplicates(odd_docs).collect())
    assert got == Counter(brute(rows))


def test_no_documents(no_docs):
    out = jaccard.near_duplicates(no_docs)
    assert out.columns == ["doc_id", "n_shingles", "component_id"] and out.count() == 0


def test_threshold_is_exact():
    """Intersections at, just below and just above 80 percent."""
    for both, own, linked in ((80, 10, True), (79, 10, False), (4, 0, True), (79, 11, False)):
        a = np.arange(both + own, dtype=np.uint64)
        b = np.concatenate([a[:both], np.arange(1000, 1000 + own, dtype=np.uint64)])
        pairs = jaccard.region_links(np.array([len(a), len(b)]), [a, b])
        union = both + 2 * own
        assert bool(pairs) == (100 * both >= 80 * union) == linked


def test_finished_balls_lose_no_link():
    """Pivot elimination against all pairs, over random overlapping sets."""
    draw = np.random.default_rng(5)
    for _ in range(60):
        base = draw.choice(60, 30, replace=False)
        sets = []
        for _ in range(draw.integers(2, 25)):
            keep = base[draw.random(30) > draw.choice([0.0, 0.05, 0.15])]
            sets.append(np.unique(np.concatenate([keep, draw.integers(100, 140, draw.integers(1, 5))])).astype(np.uint64))
        sizes = np.array([len(s) for s in sets])

        def parts(pairs, n=len(sets)):
            part = list(range(n))
            for i, j in pairs:
                part = [part[i] if p == part[j] else p for p in part]
            return len(set(part))

        everything = [(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))]
        found = jaccard.region_links(sizes, sets)
        assert set(map(frozenset, found)) <= set(map(frozenset, everything))
        assert parts(found) == parts(everything)


def test_shingle_sets_of_chunks():
    texts = ["A b  c d e f", "", "one", "x " * 500 + "y", "É é z", "q" * 2000 + " r", "a b c d e f"]
    body = np.frombuffer("".join(texts).encode(), np.uint8)
    bounds = np.cumsum([0, *[len(t.encode()) for t in texts]])
    hashes, sizes = words.shingle_sets(body, bounds)
    assert sizes.tolist() == [len(shingles(t)) for t in texts]
    prints = words.set_fingerprints(hashes, sizes)
    assert prints[0] == prints[6] and prints[1] == b"" and len(set(prints)) == 6


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(60)] + [(100 + i, 100) for i in range(1, 30)] + [(500, 500), (201, 200), (200, 201)]
    found = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert found == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(30)}, 200: 200, 201: 200}
