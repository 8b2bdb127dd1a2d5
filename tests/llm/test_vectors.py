"""op3 and op4: against brute force."""

import math
from collections import defaultdict

import numpy as np
import pytest

from curbline.llm import ann, neardup


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, score double, first long, tile int")


def usable(e):
    return bool(e) and all(x is not None and math.isfinite(x) for x in e) and any(e)


def clustered(seed, n=500, dims=8, centres=15):
    draw = np.random.default_rng(seed)
    centre = draw.standard_normal((centres, dims))
    rows = []
    for i in range(n):
        v = centre[i % centres] * draw.choice([1.0, 3.0]) + draw.choice([0.0, 0.05, 0.3]) * draw.standard_normal(dims)
        rows.append((int(i), v.tolist(), int(i % centres % 3), 0.0, 0, 0))
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [0.0] * dims, [nan] * dims, [None] * dims, [1.0, 2.0], [2.0, 4.0], [inf] * dims, [5e-324] * dims, [2e200] * dims, [1e200] * dims]
    rows += [(1000 + i, e, 1, 0.0, 0, 0) for i, e in enumerate(odd)]
    return rows + [(1100, [1.0, 2.0], None, 0.0, 0, 0), rows[3], rows[3]]


def links(rows, threshold=0.98):
    """Per row (n_links, component) by all pairs within labels."""
    groups, n, part = defaultdict(list), [0] * len(rows), list(range(len(rows)))
    for at, (_, e, label, *_) in enumerate(rows):
        if label is not None and usable(e):
            v = np.array(e) / np.max(np.abs(e))
            groups[label, len(e)].append((at, v / np.linalg.norm(v)))

    def root(x):
        while part[x] != x:
            x = part[x]
        return x

    for members in groups.values():
        unit = np.array([v for _, v in members])
        for i, j in zip(*np.nonzero(np.triu(unit @ unit.T >= threshold, 1)), strict=True):
            a, b = members[i][0], members[j][0]
            n[a] += 1
            n[b] += 1
            part[root(a)] = root(b)
    least = defaultdict(lambda: 1 << 60)
    for at, row in enumerate(rows):
        least[root(at)] = min(least[root(at)], row[0])
    return sorted((row[0], n[at], least[root(at)], row[0] == least[root(at)]) for at, row in enumerate(rows))


@pytest.mark.parametrize(("seed", "tile_rows"), [(1, 1024), (2, 25), (3, 7)])
def test_near_duplicates(spark, seed, tile_rows):
    rows = clustered(seed)
    got = neardup.near_duplicates(vectors(spark, rows).repartition(3), tile_rows=tile_rows)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(tuple(r) for r in got.collect()) == links(rows)


def test_one_dimension_and_nothing(spark):
    rows = [(i, [x], 0, 0.0, 0, 0) for i, x in enumerate([1.0, 2.0, -1.0, -3.0, 0.0])]
    assert sorted(tuple(r) for r in neardup.near_duplicates(vectors(spark, rows)).collect()) == links(rows)
    for empty in ([], [(1, None, 1, 0.0, 0, 0)]):
        assert neardup.near_duplicates(vectors(spark, empty)).count() == len(empty)


def test_bounds_give_up_no_pair():
    draw = np.random.default_rng(3)
    for dims in (1, 5, 8, 9, 40):
        a = draw.standard_normal((60, dims))
        a = np.vstack([a, a[:20] + 0.1 * draw.standard_normal((20, dims))])
        a /= np.linalg.norm(a, axis=1, keepdims=True)
        i, j = neardup.tile_links(a, a, lambda i, j, a=a: (a[i] * a[j]).sum(axis=1), 0.9)
        exact = (a[:, None, :] * a[None]).sum(axis=2) >= 0.9
        assert set(zip(i.tolist(), j.tolist(), strict=True)) == set(zip(*(x.tolist() for x in np.nonzero(exact)), strict=True))


def best(rows, k):
    """{query: [(score, id)]} by all inner products, ids divisible by 20."""
    kept = {(i, tuple(e)) for i, e, *_ in rows if usable(e)}
    out = {}
    for q, e in kept:
        if q % 20 == 0:
            near = sorted((-sum(np.multiply(e, f)), i) for i, f in kept if i != q and len(f) == len(e))
            out[q] = [(-s, i) for s, i in near[:k]]
    return out


def test_forest_that_takes_all_is_exact(spark):
    """With as many candidates as rows the order, the ties and the ranks are those of
    brute force; shards and blocks change nothing."""
    rows = [r for r in clustered(4, 200) if r[0] not in (1008, 1009, 1010)]
    rows += [(2000 + i, rows[20][1], 0, 0.0, 0, 0) for i in range(40)]
    table = vectors(spark, rows)
    got = defaultdict(list)
    found = ann.nearest(table, table.where("vec_id % 20 = 0"), k=9, candidates=50.0, shard_rows=64)
    assert found.columns == ["query_id", "rank", "vec_id", "score", "scored"]
    for r in sorted(found.collect()):
        got[r.query_id].append((r.score, r.vec_id))
        assert r.rank == len(got[r.query_id])
    want = best(rows, 9)
    assert set(got) == {q for q in want if want[q]}
    for q, near in got.items():
        assert [i for _, i in near] == [i for _, i in want[q]]
        assert [s for s, _ in near] == pytest.approx([s for s, _ in want[q]])


def test_recall_over_the_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    ids, x = np.array([i for i, _ in rows]), np.array([e for _, e in rows], float)
    hits = total = 0
    found = defaultdict(list)
    for r in ann.nearest(table, table.where("vec_id % 20 = 0")).collect():
        found[r.query_id].append(r.vec_id)
        assert r.score == pytest.approx(float(x[ids == r.query_id][0] @ x[ids == r.vec_id][0]))
    for q in ids[ids % 20 == 0]:
        score = x @ x[ids == q][0]
        score[ids == q] = -np.inf
        want = set(ids[np.lexsort((ids, -score))[:20]].tolist())
        hits += len(want & set(found[q]))
        total += 20
        assert len(found[q]) == 20
    assert hits / total >= 0.9


def test_neighbours_that_are_near_end_the_search():
    """Among clustered vectors few rows are scored, and nearly all neighbours found."""
    draw = np.random.default_rng(6)
    x = np.repeat(draw.standard_normal((400, 64)), 40, axis=0) + 0.4 * draw.standard_normal((16_000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids, asked = np.arange(len(x)), np.arange(0, len(x), 400)
    planes = draw.standard_normal((ann.TREES, ann.BITS, 65))
    strings = ann.hash_strings(np.column_stack([x, np.zeros(len(x))]), planes)
    hits, share = 0, []
    for q, near, _, scored in ann.best(ann.Forest(strings), x, ids, strings[:, asked], x[asked], asked, 20, 320, 1.0, ann.MISSED):
        product = x @ x[asked[q]]
        product[asked[q]] = -2
        hits += len(set(near) & set(np.argsort(-product)[:20]))
        share.append(scored / len(x))
    assert hits >= 0.9 * 20 * len(asked) and np.mean(share) <= 0.1


def test_unequal_norms(spark):
    """The largest inner product is not the smallest angle."""
    draw = np.random.default_rng(8)
    rows = [(i, (draw.standard_normal(16) * draw.choice([0.2, 1.0, 4.0])).tolist(), 0, 0.0, 0, 0) for i in range(400)]
    table, want = vectors(spark, rows), best(rows, 20)
    found = defaultdict(set)
    for r in ann.nearest(table, table.where("vec_id % 20 = 0")).collect():
        found[r.query_id].add(r.vec_id)
    assert np.mean([len(found[q] & {i for _, i in want[q]}) / 20 for q in want]) >= 0.9


def test_every_query_gets_what_it_is_owed(spark):
    """Few rows with a group of copies, whose entries alone are candidates enough."""
    draw = np.random.default_rng(11)
    rows = []
    for dims, n, copies in ((8, 53, 8), (16, 100, 15), (5, 9, 0), (6, 21, 20), (7, 1, 0), (9, 20, 3)):
        x = draw.standard_normal((n, dims))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        x[:copies] = x[0]
        rows += [(1000 * dims + i, v.tolist(), 0, 0.0, 0, 0) for i, v in enumerate(x)]
    table, want = vectors(spark, rows), best(rows, 20)
    found = defaultdict(list)
    for r in ann.nearest(table, table.where("vec_id % 20 = 0")).collect():
        found[r.query_id].append(r.vec_id)
    assert {q: len(found[q]) for q in want} == {q: len(near) for q, near in want.items()}
    assert all(len(set(near)) == len(near) for near in found.values())
    for q, near in want.items():  # with 20 rows or fewer to compare with, these are all
        if len(near) < 20:
            assert found[q] == [i for _, i in near]


def test_nothing_to_search(spark):
    none = vectors(spark, [])
    some = vectors(spark, [(20, [1.0, 2.0], 0, 0.0, 0, 0)])
    assert ann.nearest(none, none).count() == ann.nearest(some, none).count() == ann.nearest(some, some).count() == 0
