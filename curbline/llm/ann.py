"""Approximate nearest neighbours by a forest of hash prefixes (LSH forest).

Every tree gives a vector a string of 64 random-hyperplane bits and keeps its
vectors as an array sorted by string. A query descends to its longest matching
prefix in every tree and then ascends in all trees at the same time, one bit a
step or more. It stops as soon as a row as near as the k-th best found so far would be found
with a chance of 1 - ``missed`` at least: two vectors at an angle a share a bit with
chance 1 - a / pi, so they share a prefix of d bits in at least one of t trees with
1 - (1 - (1 - a / pi)^d)^t. So a query among near neighbours stops at long prefixes and
scores few rows, and one without any goes up far; at the root all rows are candidates.
Candidates of one depth are a range of the sorted array, so a large group of equal
vectors is found as a whole. All candidates are scored on the original vectors.

Nearness is the inner product. Vectors get one more component that makes all norms
equal (queries get 0 there), which turns the largest inner product into the
smallest angle, what the hashes see.

All rows are indexed. They are dealt to shards of bounded size, each a task with
the whole forest over its rows; the stated queries meet the shards in blocks, and
the best of all shards are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curbline.llm.neardup import VALID
from curbline.session import settled

TREES, BITS, SEED = 128, 64, 29
#: Rows of a shard, queries of a block, and the chance that a row as near as the last of
#: the k best is missed.
SHARD_ROWS, BLOCK_QUERIES, MISSED = 16384, 2048, 0.1
#: Scalar products at a time.
SCORED = 1 << 18


def hash_strings(x: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Strings of 64 bits of the rows of x, one row a tree, as unsigned integers."""
    out, x = np.empty((len(planes), len(x)), np.uint64), x.astype(np.float32)
    for t, normals in enumerate(planes.astype(np.float32)):
        bits = np.packbits(x @ normals.T > 0, axis=1)
        out[t] = bits.view(">u8")[:, 0]
    return out


class Forest:
    """Sorted arrays of hash strings over some rows, one a tree."""

    def __init__(self, strings: np.ndarray):
        self.order = np.argsort(strings, axis=1, kind="stable")
        self.sorted = np.take_along_axis(strings, self.order, axis=1)

    def below(self, queries: np.ndarray, depths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last position in every tree (trees, queries) of the rows that share
        as many bits with each query as ``depths`` tells."""
        rest = np.array([(1 << (BITS - d)) - 1 for d in range(BITS + 1)], np.uint64)[depths]
        low = np.stack([np.searchsorted(own, q & ~rest, "left") for own, q in zip(self.sorted, queries, strict=True)])
        high = np.stack([np.searchsorted(own, q | rest, "right") for own, q in zip(self.sorted, queries, strict=True)])
        return low, high

    def depths(self, queries: np.ndarray, enough: float) -> np.ndarray:
        """For each query the greatest depth at which all trees together have ``enough``
        rows, found by halving; 0 is the root, which has all rows."""
        low, high = np.zeros(queries.shape[1], np.int64), np.full(queries.shape[1], BITS)
        while (low < high).any():
            middle = (low + high + 1) // 2
            first, last = self.below(queries, middle)
            held = (last - first).sum(axis=0) >= enough
            low, high = np.where(held, middle, low), np.where(held, high, middle - 1)
        return low


def top(found: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of some rows, ties by id."""
    if len(found) > k:
        edge = np.partition(score, len(score) - k)[len(score) - k]
        found, score = found[score >= edge], score[score >= edge]
    order = np.lexsort((ids[found], -score))[:k]
    return found[order], score[order]


def best(forest: Forest, x: np.ndarray, ids: np.ndarray, strings: np.ndarray, queries: np.ndarray, own: np.ndarray, k: int, enough: float, longest: float, missed: float) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """Of every query its k best candidates: number, ids, inner products, rows scored.
    ``longest`` is the norm that all vectors of the forest have."""
    norms, trees = np.sqrt((queries * queries).sum(axis=1)) * longest, len(strings)
    near = [(np.zeros(0, np.int64), np.zeros(0))] * len(queries)
    scored = [np.zeros(0, np.int64)] * len(queries)
    seen = np.zeros(len(x), bool)
    depths, climbing = forest.depths(strings, enough), np.arange(len(queries))
    while len(climbing):
        first, last = forest.below(strings[:, climbing], depths[climbing])
        on = []
        for q, low, high in zip(climbing.tolist(), first.T.tolist(), last.T.tolist(), strict=True):
            for rows, start, end in zip(forest.order, low, high, strict=True):
                seen[rows[start:end]] = True
            new = seen.copy()
            new[scored[q]] = False
            scored[q], new = np.flatnonzero(seen), np.flatnonzero(new)
            seen[scored[q]] = False
            new = new[ids[new] != own[q]]
            score = np.empty(len(new))
            for at in range(0, len(new), SCORED):
                part = new[at : at + SCORED]
                score[at : at + len(part)] = np.einsum("ij,j->i", x[part], queries[q])
            near[q] = top(np.concatenate([near[q][0], new]), np.concatenate([near[q][1], score]), ids, k)
            depth, goal = int(depths[q]), 0
            if len(near[q][0]) == k:
                bit = 1 - np.arccos(np.clip(near[q][1][-1] / norms[q], -1, 1)) / np.pi
                goal = _depth(bit, trees, missed)
            if depth <= goal:
                yield q, ids[near[q][0]], near[q][1], len(scored[q])
                scored[q] = np.zeros(0, np.int64)
            else:  # half the way to where these neighbours call for, as better ones may come
                depths[q] = (depth + goal) // 2
                on.append(q)
        climbing = np.array(on, np.int64)


def _depth(bit: float, trees: int, missed: float) -> int:
    """The greatest depth at which two vectors that share a bit with chance ``bit`` have it
    in common in no tree with a chance of ``missed`` at most; 0 is the root."""
    return next((d for d in range(BITS, 0, -1) if (1 - bit**d) ** trees <= missed), 0)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    trees: int = TREES,
    missed: float = MISSED,
    candidates: float = 0.0,
    shard_rows: int = SHARD_ROWS,
    seed: int = SEED,
) -> DataFrame:
    """(query_id, rank, vec_id, score, scored): the k nearest found of every query, and how
    many rows the query was compared with. ``candidates`` asks for more of them: a share
    of the rows, counted tree by tree.

    ``vectors`` and ``queries`` have vec_id and embedding. Nearness is the inner
    product in double precision; ties go to the smaller vec_id. A query's own row
    (its vec_id) is no candidate. Vectors that are null, empty, zero or hold null or
    non-finite components, and null ids, take no part; vectors of another number of
    dimensions are not compared. Repeated rows of one id and vector count once. Each
    query gets k rows, or as many as it can be compared with if these are fewer; an
    empty side gives none. Other columns are not read.
    """
    spark = vectors.sparkSession
    plain = ["CAST(vec_id AS bigint) AS vec_id", "CAST(embedding AS array<double>) AS embedding"]
    some = f"coalesce(vec_id IS NOT NULL AND {VALID} AND exists(embedding, x -> x <> 0), false)"
    rows = settled(vectors.selectExpr(*plain).where(some).distinct(), "vectors")
    asked = settled(queries.selectExpr(*plain).where(some).distinct(), "queries")
    square = F.expr("aggregate(embedding, 0D, (s, x) -> s + x * x)")
    about = rows.groupBy(F.size("embedding").alias("dims")).agg(F.max(square).alias("top"), F.count("*").alias("rows"))
    about = {r["dims"]: (r["top"], -(-r["rows"] // shard_rows)) for r in about.collect()}
    counts = asked.groupBy(F.size("embedding").alias("dims")).count()
    blocks = {r["dims"]: -(-r["count"] // BLOCK_QUERIES) for r in counts.collect() if r["dims"] in about}

    sides = []
    for dims, n_blocks in blocks.items():
        n_shards = about[dims][1]
        shard, block = F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(n_shards)), F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks))
        every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        base = rows.where(F.size("embedding") == dims).select(F.lit(dims).alias("dims"), shard.cast("int").alias("shard"), every(n_blocks).alias("block"), F.lit(False).alias("asks"), "vec_id", "embedding")
        ask = asked.where(F.size("embedding") == dims).select(F.lit(dims).alias("dims"), every(n_shards).alias("shard"), block.cast("int").alias("block"), F.lit(True).alias("asks"), "vec_id", "embedding")
        sides += [base, ask]
    found_type = "query_id long, vec_id long, score double, scored long"
    if not sides:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double, scored long")
    both = sides[0]
    for side in sides[1:]:
        both = both.union(side)

    def search(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        dims = table["dims"][0].as_py()
        asks = np.array(table["asks"].to_pylist(), bool)
        every, ids = _matrix(table["embedding"].combine_chunks(), dims), table["vec_id"].to_numpy()
        x, own_ids, q, own = every[~asks], ids[~asks], every[asks], ids[asks]
        out: list[list] = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)], [np.zeros(0, np.int64)]]
        if len(x) and len(q):
            planes = np.random.default_rng(seed).standard_normal((trees, BITS, dims + 1))
            lift = np.sqrt(np.maximum(about[dims][0] - (x * x).sum(axis=1), 0))
            forest = Forest(hash_strings(np.column_stack([x, lift]), planes))
            strings = hash_strings(np.column_stack([q, np.zeros(len(q))]), planes)
            longest = float(np.sqrt(about[dims][0]))
            for n, near, score, seen in best(forest, x, own_ids, strings, q, own, k, max(candidates * len(x), 16 * k), longest, missed):
                out[0].append(np.full(len(near), own[n]))
                out[1].append(near)
                out[2].append(score)
                out[3].append(np.where(np.arange(len(near)) == 0, seen, 0))
        return pa.table([pa.array(np.concatenate(c)) for c in out], ["query_id", "vec_id", "score", "scored"])

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = both.repartition(n, "dims", "shard", "block").groupBy("dims", "shard", "block").applyInArrow(search, found_type)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    counted = found.withColumn("scored", F.sum("scored").over(Window.partitionBy("query_id")))
    ranked = counted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score", "scored")
