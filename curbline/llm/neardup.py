"""Near duplicates of vectors by tiles in the order of principal axes.

Vectors are compared within a label. All are turned onto the principal axes of the
whole table, so that leading dimensions carry most of a product. Rows of a label
are dealt to cells along the first axis, as wide as two linked vectors can lie
apart there, and cells to tiles of bounded size; a tile meets the tiles of its own
and the next cell only. Within a pair of tiles products are accumulated from the
leading dimensions on: with what is left bounded by the norms of the suffixes, a
pair is given up as soon as its cosine cannot reach the threshold. Survivors are
decided by the cosine of the original vectors in double precision.

Exact copies are one vector with a count, so no group of copies is expanded. A
pair of tiles sends on the number of links of each vector and the links that tie
its components together, not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm.components import components
from curbline.session import settled

THRESHOLD, TILE_ROWS = 0.98, 1024
#: Dimensions added at a time.
STEP = 8
#: Bounds are widened by this much, so that rounding gives up no pair.
SLACK = 1e-9
VALID = "size(embedding) > 0 AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('inf'))"


def usable(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(id, label, embedding, scaled) of the rows that can be compared, as doubles."""
    kept = vectors.select(
        F.col(id_column).cast("long").alias("id"),
        "label",
        F.col(vector_column).cast("array<double>").alias("embedding"),
    ).where(f"coalesce({VALID}, false)")
    # scaled, so that squares of very large or small components stay in range
    kept = kept.withColumn("top", F.expr("array_max(transform(embedding, x -> abs(x)))")).where("top > 0")
    return kept.select("id", "label", "embedding", F.expr("transform(embedding, x -> x / top)").alias("scaled"))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def principal_axes(unit: DataFrame, size: int) -> np.ndarray:
    """Axes of the vectors of ``size`` dimensions as columns, largest spread first;
    from sums over all rows, of size by size numbers a task."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            x = _unit(_matrix(batch.column(0)))
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(range(size)), pa.array(list(total))], ["row", "sums"])

    parts = unit.select("scaled").mapInArrow(sums, "row long, sums array<double>")
    added = parts.select("row", F.posexplode("sums").alias("col", "x")).groupBy("row", "col").agg(F.sum("x").alias("x"))
    gram = np.zeros((size, size))
    for r in added.collect():
        gram[r["row"], r["col"]] = r["x"]
    return np.linalg.eigh((gram + gram.T) / 2)[1][:, ::-1].copy()


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def tile_links(a: np.ndarray, b: np.ndarray, exact, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows i of ``a`` and j of ``b`` (unit vectors on principal axes) that are linked;
    ``exact`` gives the cosines that decide."""
    rest_a = np.sqrt(np.maximum(np.cumsum((a * a)[:, ::-1], axis=1)[:, ::-1], 0))
    rest_b = np.sqrt(np.maximum(np.cumsum((b * b)[:, ::-1], axis=1)[:, ::-1], 0))
    size, at = a.shape[1], min(STEP, a.shape[1])
    dot = a[:, :at] @ b[:, :at].T
    if at < size:
        open_ = dot + rest_a[:, at, None] * rest_b[None, :, at] >= threshold - SLACK
    else:
        open_ = dot >= threshold - SLACK
    i, j = np.nonzero(open_)
    dot = dot[i, j]
    while at < size and len(i):
        end = min(at + STEP, size)
        dot = dot + (a[i, at:end] * b[j, at:end]).sum(axis=1)
        rest = rest_a[i, end] * rest_b[j, end] if end < size else 0.0
        keep = dot + rest >= threshold - SLACK
        i, j, dot, at = i[keep], j[keep], dot[keep], end
    keep = exact(i, j) >= threshold
    return i[keep], j[keep]


def _forest(nodes: int, i: np.ndarray, j: np.ndarray) -> list[tuple[int, int]]:
    """Of some links enough to tie the same components together."""
    parent = list(range(nodes))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for x, y in zip(i.tolist(), j.tolist(), strict=True):
        a, b = root(x), root(y)
        if a != b:
            parent[max(a, b)] = min(a, b)
            out.append((x, y))
    return out


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors`` (vec_id,
    embedding, label).

    Two rows are linked if their labels are equal and not null, their vectors have as
    many dimensions and a cosine of at least ``threshold``. A vector that is null,
    empty, zero or holds a null or a number that is not finite has no links and only
    itself as component. Repeated rows are linked with each other like any copies.
    ``kept`` tells whether vec_id is the smallest id of its component (of a null
    label or an unusable vector: true). A null id never is the smallest. Other
    columns are not read; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = usable(vectors).where("label IS NOT NULL AND id IS NOT NULL")
    copies = rows.groupBy("label", "embedding", "scaled").agg(F.min("id").alias("first"), F.count("*").alias("copies"))
    copies = settled(copies.withColumn("dims", F.size("embedding")), "vectors")
    sizes = [r[0] for r in copies.select("dims").distinct().orderBy("dims").collect()]
    width = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-6

    turned = None
    for size in sizes:
        own = copies.where(F.col("dims") == size)
        axes = principal_axes(own, size)

        def turn(batches: Iterator[pa.RecordBatch], axes: np.ndarray = axes) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = _unit(_matrix(batch.column(2))) @ axes
                turned = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))
                cell = pa.array(np.floor(x[:, 0] / width).astype(np.int64))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), cell, turned, batch.column(2)], ["first", "copies", "group", "cell", "turned", "scaled"])

        group = F.concat_ws(":", F.lit(size), F.col("label").cast("string")).alias("group")
        part = own.select("first", "copies", "scaled", group).mapInArrow(turn, "first long, copies long, group string, cell long, turned array<double>, scaled array<double>")
        turned = part if turned is None else turned.union(part)
    out = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    if turned is None:
        return out.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))

    turned = settled(turned, "turned")
    tiles = turned.groupBy("group", "cell").agg(F.ceil(F.count("*") / tile_rows).cast("int").alias("tiles"))
    later = tiles.select("group", (F.col("cell") - 1).alias("cell"), F.col("tiles").alias("next_tiles"))
    earlier = tiles.select("group", (F.col("cell") + 1).alias("cell"), F.col("tiles").alias("last_tiles"))
    dealt = turned.join(tiles, ["group", "cell"]).join(later, ["group", "cell"], "left").join(earlier, ["group", "cell"], "left")
    dealt = dealt.withColumn("tile", F.pmod(F.xxhash64("first"), F.col("tiles")).cast("int"))
    # meetings of a tile: with each tile of its cell (once a pair), of the next cell, of the last cell
    meet = F.expr("""concat(
        transform(sequence(0, tiles - 1), t -> struct(cell AS cell, 0 AS step, least(t, tile) AS a, greatest(t, tile) AS b, t >= tile AS left)),
        transform(sequence(0, coalesce(next_tiles, 0)), t -> IF(t = coalesce(next_tiles, 0), NULL, struct(cell AS cell, 1 AS step, tile AS a, t AS b, true AS left))),
        transform(sequence(0, coalesce(last_tiles, 0)), t -> IF(t = coalesce(last_tiles, 0), NULL, struct(cell - 1 AS cell, 1 AS step, t AS a, tile AS b, false AS left))))""")
    met = dealt.select("first", "copies", "group", "turned", "scaled", F.explode(F.filter(meet, lambda m: m.isNotNull())).alias("m"))
    meeting = F.concat_ws("/", "group", "m.cell", "m.step", "m.a", "m.b").alias("meeting")
    own = ((F.col("m.step") == 0) & (F.col("m.a") == F.col("m.b"))).alias("own")
    met = met.select(meeting, F.col("m.left").alias("left"), own, "first", "copies", "turned", "scaled")

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        first, copies = table["first"].to_numpy(), table["copies"].to_numpy()
        x, scaled = _matrix(table["turned"].combine_chunks()), _matrix(table["scaled"].combine_chunks())
        norm = np.sqrt((scaled * scaled).sum(axis=1))
        own, left = table["own"][0].as_py(), np.array(table["left"].to_pylist(), bool)
        a, b = (np.arange(len(first)),) * 2 if own else (np.flatnonzero(left), np.flatnonzero(~left))

        def exact(i: np.ndarray, j: np.ndarray) -> np.ndarray:
            out = np.empty(len(i))
            for at in range(0, len(i), 1 << 16):
                p, q = a[i[at : at + (1 << 16)]], b[j[at : at + (1 << 16)]]
                out[at : at + len(p)] = (scaled[p] * scaled[q]).sum(axis=1) / (norm[p] * norm[q])
            return out

        if not len(a) or not len(b):
            i = j = np.zeros(0, np.int64)
        else:
            i, j = tile_links(x[a], x[b], exact, threshold)
        i, j = a[i], b[j]
        if own:  # each pair once
            i, j = i[i < j], j[i < j]
        links = np.bincount(i, copies[j], len(first)) + np.bincount(j, copies[i], len(first))
        some = np.flatnonzero(links)
        tied = _forest(len(first), i, j)
        ends = ([first[p] for p, _ in tied], [first[q] for _, q in tied])
        return pa.table({
            "first": pa.array([*first[some], *ends[0]], pa.int64()),
            "links": pa.array([*links[some].astype(np.int64), *[None] * len(tied)], pa.int64()),
            "other": pa.array([*[None] * len(some), *ends[1]], pa.int64()),
        })

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = met.repartition(n, "meeting").groupBy("meeting").applyInArrow(compare, "first long, links long, other long")
    found = settled(found, "found")
    links = found.where("other IS NULL").groupBy("first").agg(F.sum("links").alias("links"))
    stars = components(found.where("other IS NOT NULL").select(F.col("first").alias("a"), F.col("other").alias("b")))
    classes = copies.select("label", "embedding", "first", "copies").join(links, "first", "left")
    classes = classes.join(stars.withColumnRenamed("node", "first"), "first", "left")
    classes = classes.select(F.col("label").alias("l"), F.col("embedding").alias("e"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "first").alias("component_id"))
    compared = out.withColumn("ok", F.expr(f"coalesce({VALID}, false)") & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
    joined = compared.where("ok").join(classes, (F.col("label") == F.col("l")) & (F.col("embedding") == F.col("e")), "left")
    joined = joined.union(compared.where("NOT ok").select("*", *[F.lit(None).cast(t) for t in ("int", "array<double>", "long", "long")]))
    component = F.coalesce("component_id", "vec_id")
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
