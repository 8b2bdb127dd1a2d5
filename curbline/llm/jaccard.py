"""Exact Jaccard join of documents on word shingles, by pivots in a metric space.

Jaccard distance is a metric, but most documents lie at distance 1 from each
other, where a pivot tells nothing apart. So pivots are seeded where distances
are below 1, through an inverted index:

1. A pass over the texts deals every shingle of every document to hash buckets
   (packed arrays, about 6 bytes a shingle). A bucket knows the exact document
   frequency of its shingles and sends the shared ones back. A document of n
   shingles of which fewer than the threshold's share are shared has no partner
   and leaves.
2. The others take their rarest shingles, as many as guarantee that two documents
   above the threshold share one (prefix filter). The documents that hold such a
   shingle form the region of its smallest document, the pivot.
3. Within a region, distances to a pivot decide: who is within the radius is
   linked; who lies outside twice the radius cannot be linked to anyone within it
   (triangle inequality), so a ball with an empty ring around it is finished.
   What stays open goes on with the next pivot.
4. A region too large for a task is first split into Voronoi regions of several
   pivots. A document is replicated to each region whose pivot is nearer than its
   own pivot plus twice the radius, the triangle window, and regions are split
   again. Where everything lies within the window a split gains nothing; such a
   region is compared tile by tile.

Only what ties components together is emitted: links to pivots, never all pairs of
a group. Distances are compared in integers, so the threshold is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm import words as W
from curbline.llm.components import components
from curbline.session import settled

SHINGLE_WORDS, PERCENT = 5, 80
#: Texts dealt out at a time, in bytes; a task holds some ten times as much in arrays.
BLOCK_BYTES = 8 << 20
#: Buckets that a shuffle partition takes up one after the other.
BUCKETS_A_PARTITION = 4
#: Documents of a region that one task compares.
REGION_DOCS = 2048
#: Pivots of one split, and splits before tiles take over.
PIVOTS, MAX_SPLITS = 8, 3

#: Short name of a set between the steps; sets of one key share regions, no more.
KEY = "cast(conv(hex(substring(print, 1, 7)), 16, 10) AS bigint) AS key"

DEALT = "bucket int, block long, first int, low binary, high binary, n binary, ids array<long>, sizes array<int>, prints array<binary>"
SHARED = "bucket int, block long, doc binary, low binary, high binary, df binary, ids array<long>, sizes array<int>, prints array<binary>"
INDEXED = "id long, n long, print binary, shingles binary, prefix int"


def _deal(buckets: int):
    """Shingles of a task's documents, dealt to buckets by the top bits of their hashes."""
    edges = np.array([((i << 56) + buckets - 1) // buckets for i in range(1, buckets)], np.uint64)

    def rows_of(block: int, hashes: list, sizes: list, ids: list) -> pa.RecordBatch:
        n = np.concatenate(sizes)
        h = np.concatenate(hashes)
        doc = np.repeat(np.arange(len(n)), n)
        bucket = np.searchsorted(edges, h, "right")
        order = np.argsort(bucket, kind="stable")
        h, doc, cuts = h[order], doc[order], np.searchsorted(bucket[order], np.arange(buckets + 1))
        prints = []
        at = 0
        for one, size in zip(hashes, sizes, strict=True):
            prints += W.set_fingerprints(one, size)
            at += len(size)
        out = []
        for b in range(buckets):
            part = slice(cuts[b], cuts[b + 1])
            if cuts[b] < cuts[b + 1]:
                first = int(doc[part][0])
                held = np.bincount(doc[part] - first)
                low, high = h[part].astype(np.uint32), (h[part] >> np.uint64(32)).astype(np.uint16)
                most = int(held.max())
                counts = held.astype(np.uint8 if most < 256 else np.uint16 if most < 65536 else np.uint32)
                out.append((b, block, first, low.tobytes(), high.tobytes(), b"%d" % counts.itemsize + counts.tobytes(), None, None, None))
        out.append((-1 - (31 * (block >> 24) + (block & 0xFFFFFF)) % buckets, block, 0, None, None, None, ids, n.tolist(), prints))
        return _batch(out, DEALT)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = TaskContext.get().partitionId() << 24, 0
        hashes, sizes, ids = [], [], []
        for batch in batches:
            body, bounds = W.text_bytes(batch.column(1))
            names = batch.column(0).to_pylist()
            for first, last in W.chunks(bounds):
                start, end = bounds[first], bounds[last]
                h, n = W.shingle_sets(body[start:end], bounds[first : last + 1] - start)
                hashes.append(h)
                sizes.append(n)
                ids += names[first:last]
                held += end - start
                if held >= BLOCK_BYTES:
                    yield rows_of(block, hashes, sizes, ids)
                    block, held, hashes, sizes, ids = block + 1, 0, [], [], []
        if ids:
            yield rows_of(block, hashes, sizes, ids)

    return deal


ARROW = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()), "array<binary>": pa.list_(pa.binary()), "array<double>": pa.list_(pa.float64()), "string": pa.string()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split(" ") for f in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else [[] for _ in fields]
    arrays = [pa.array(list(c), ARROW[kind]) for c, (_, kind) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


def _counts(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, f"u{int(packed[:1])}", offset=1)


def _find_shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each bucket the shingles that two documents hold, back to their blocks."""
    by_bucket: dict[int, list] = {}
    for batch in batches:
        for row in batch.to_pylist():
            if row["bucket"] < 0:
                yield _batch([(-1, row["block"], None, None, None, None, row["ids"], row["sizes"], row["prints"])], SHARED)
            else:
                by_bucket.setdefault(row["bucket"], []).append((row["block"], row["first"], row["low"], row["high"], row["n"]))
    for bucket in list(by_bucket):
        rows = by_bucket.pop(bucket)
        low = np.concatenate([np.frombuffer(r[2], np.uint32) for r in rows]).astype(np.uint64)
        low |= np.concatenate([np.frombuffer(r[3], np.uint16) for r in rows]).astype(np.uint64) << np.uint64(32)
        owner = [np.repeat(np.arange(len(c)) + r[1], c) for r in rows for c in [_counts(r[4])]]
        owner = np.concatenate([o + (i << 32) for i, o in enumerate(owner)])
        order = np.argsort(low)
        low, owner = low[order], owner[order]
        cuts = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1], [True]]))
        df = np.repeat(np.diff(cuts), np.diff(cuts))
        keep = df > 1
        low, owner, df = low[keep], owner[keep], np.minimum(df[keep], 65535).astype(np.uint16)
        order = np.argsort(owner)
        low, owner, df = low[order], owner[order], df[order]
        ends = np.searchsorted(owner, np.arange(len(rows) + 1) << 32)
        out = []
        for i, row in enumerate(rows):
            part = slice(ends[i], ends[i + 1])
            if ends[i] < ends[i + 1]:
                doc = (owner[part] & 0xFFFFFFFF).astype(np.uint32)
                out.append((bucket, row[0], doc.tobytes(), low[part].astype(np.uint32).tobytes(), (low[part] >> np.uint64(32)).astype(np.uint16).tobytes(), df[part].tobytes(), None, None, None))
        if out:
            yield _batch(out, SHARED)


def _select(percent: int):
    """Per document of a block: its set size and, where a partner is possible, its
    shared shingles, rarest first, with the length of the prefix to be joined on."""

    def select(block: pa.Table) -> pa.Table:
        rows = block.to_pylist()
        about = [r for r in rows if r["bucket"] < 0]
        parts = [r for r in rows if r["bucket"] >= 0]
        ids, n, prints = about[0]["ids"], np.array(about[0]["sizes"], np.int64), about[0]["prints"]
        kept: dict[int, tuple[bytes, int]] = {}
        if parts:
            doc = np.concatenate([np.frombuffer(r["doc"], np.uint32) for r in parts]).astype(np.int64)
            have = np.bincount(doc, minlength=len(n))
            possible = (100 * have >= percent * n) & (n > 0)
            part = [possible[np.frombuffer(r["doc"], np.uint32)] for r in parts]
            doc = doc[np.concatenate(part)]
            df = np.concatenate([np.frombuffer(r["df"], np.uint16)[k] for r, k in zip(parts, part, strict=True)])
            name = np.concatenate([
                (np.uint64(r["bucket"] & 0xFFFF) << np.uint64(48)) | (np.frombuffer(r["high"], np.uint16)[k].astype(np.uint64) << np.uint64(32)) | np.frombuffer(r["low"], np.uint32)[k].astype(np.uint64)
                for r, k in zip(parts, part, strict=True)
            ])
            order = np.lexsort((name, df, doc))
            name, ends = name[order], np.cumsum(np.bincount(doc, minlength=len(n)))
            for i in np.flatnonzero(possible):
                prefix = n[i] - -(-percent * n[i] // 100) + 1 - (n[i] - have[i])
                kept[int(i)] = name[ends[i] - have[i] : ends[i]].tobytes(), int(prefix)
        return pa.Table.from_batches([_batch([(ids[i], int(n[i]), prints[i], *kept.get(i, (None, None))) for i in range(len(n))], INDEXED)])

    return select


def index(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", percent: int = PERCENT) -> DataFrame:
    """(id, n, print, shingles, prefix) of every document; ``shingles`` is null where
    no partner is possible, ``print`` is equal for equal sets."""
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = min(BUCKETS_A_PARTITION * partitions, 65536)
    picked = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    dealt = picked.mapInArrow(_deal(buckets), DEALT)
    shared = dealt.repartition(partitions, "bucket").mapInArrow(_find_shared, SHARED)
    return shared.groupBy("block").applyInArrow(_select(percent), INDEXED)


def region_links(sizes: np.ndarray, sets: list[np.ndarray], percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links that tie together the components of some sets, by pivots, exactly.

    Each pivot is compared with every open set. Its ball (linked sets) is finished
    with it if no open set of another component is within twice the radius: whoever
    is linked to a member of the ball would be.
    """
    ring = 2 * percent - 100  # similarity at twice the radius, in percent
    local = np.unique(np.concatenate(sets), return_inverse=True)[1]
    lengths = np.array([len(s) for s in sets])
    ends = np.cumsum(lengths)
    mark = np.zeros(len(local) and int(local.max()) + 1, bool)
    part, alive, out = np.arange(len(sets)), np.ones(len(sets), bool), []
    for p in range(len(sets)):
        if not alive[p]:
            continue
        alive[p] = False
        own = local[ends[p] - lengths[p] : ends[p]]
        mark[own] = True
        both = np.add.reduceat(mark[local], ends - lengths, dtype=np.int64)
        mark[own] = False
        union = sizes + sizes[p] - both
        linked = alive & (100 * both >= percent * union)
        for j in np.flatnonzero(linked & (part != part[p])):
            if part[j] != part[p]:
                out.append((p, int(j)))
                part[part == part[j]] = part[p]
        if not (alive & (100 * both >= ring * union) & (part != part[p])).any():
            alive &= ~linked
        if not alive.any():
            break
    return out


def _join_regions(percent: int):
    """Links within regions; rows come sorted by region."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        region, held = None, []

        def close() -> pa.RecordBatch | None:
            if len(held) < 2:
                return None
            sizes = np.array([h[1] for h in held], np.int64)
            pairs = region_links(sizes, [np.frombuffer(h[2], np.uint64) for h in held], percent)
            return _batch([(held[i][0], held[j][0]) for i, j in pairs], "a binary, b binary")

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if row[0] != region:
                    if (done := close()) is not None:
                        yield done
                    region, held = row[0], []
                held.append(row[1:])
        if (done := close()) is not None:
            yield done

    return join


def _distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distance of each set to each pivot of its region (2.0 where the pivot is itself)."""
    for batch in batches:
        out = []
        for region, name, n, held, pivots in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            own, far = np.frombuffer(held, np.uint64), []
            for p in pivots:
                both = len(np.intersect1d(own, np.frombuffer(p["shingles"], np.uint64), assume_unique=True))
                far.append(1 - both / (n + p["n"] - both))
            out.append((region, name, n, held, far, [p["print"] for p in pivots]))
        yield _batch(out, "region string, print binary, n long, shingles binary, far array<double>, pivots array<binary>")


def _split(members: DataFrame, reps: DataFrame, level: int, radius: float) -> tuple[DataFrame, DataFrame]:
    """Voronoi regions of several pivots a region, with triangle windows; and the
    links found on the way. The slack of 1e-9 only widens windows; links found here
    are within the radius by a margin, the others are left to the exact join."""
    drawn = members.withColumn("draw", F.pmod(F.xxhash64("key", F.lit(level)), F.lit(PIVOTS)))
    pivots = drawn.groupBy("region", "draw").agg(F.min("key").alias("key")).join(reps, "key")
    pivots = pivots.groupBy("region").agg(F.sort_array(F.collect_list(F.struct("print", "n", "shingles"))).alias("pivots"))
    far = settled(
        members.join(reps, "key").join(pivots, "region").select("region", "print", "n", "shingles", "pivots")
        .mapInArrow(_distances, "region string, print binary, n long, shingles binary, far array<double>, pivots array<binary>")
        .drop("shingles"),
        "distances",
    )
    near = far.select("print", F.explode(F.arrays_zip("far", "pivots")).alias("p"))
    links = near.where(F.col("p.far") <= radius - 1e-9).select(F.col("p.pivots").alias("a"), F.col("print").alias("b"))
    window = F.array_min("far") + 2 * radius + 1e-9
    homes = far.select("region", "print", F.posexplode("far").alias("home", "distance"), window.alias("window"))
    homes = homes.where(F.col("distance") <= F.col("window"))
    return homes.select(F.concat_ws("/", "region", "home").alias("region"), F.expr(KEY)).distinct(), links.where("a <> b")


def _tiles(members: DataFrame, sizes: DataFrame, region_docs: int) -> DataFrame:
    """Every pair of tiles of a region as a region of its own: exact for any region,
    with bounded tasks, at a cost that grows with the square of its size."""
    tiled = members.join(sizes, "region").withColumn("tiles", F.ceil(2 * F.col("size") / region_docs).cast("int"))
    tiled = tiled.withColumn("tile", F.pmod(F.xxhash64("key"), F.col("tiles")).cast("int"))
    pairs = tiled.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    name = F.concat_ws("/", F.col("region"), F.lit("t"), F.least("tile", "other"), F.greatest("tile", "other"))
    return pairs.select(name.alias("region"), "key")


def links(indexed: DataFrame, percent: int = PERCENT, region_docs: int = REGION_DOCS) -> DataFrame:
    """Links (a, b) between prints that tie together the components of the join."""
    spark, radius = indexed.sparkSession, 1 - percent / 100
    reps = settled(
        indexed.where("shingles IS NOT NULL")
        .select("print", "n", "shingles", "prefix", F.expr(KEY))
        .dropDuplicates(["key", "print"]),
        "sets",
    )

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, prefix = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            held = [np.frombuffer(x, np.int64, k) for x, k in zip(batch.column(1).to_pylist(), prefix, strict=True)]
            tokens = np.concatenate(held) if held else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(tokens), pa.array(np.repeat(keys, prefix))], ["token", "key"])

    postings = reps.select("key", "shingles", "prefix").mapInArrow(rarest, "token long, key long")
    shared = postings.groupBy("token").agg(F.min("key").alias("pivot"), F.max("key").alias("last")).where("pivot <> last")
    members = postings.join(shared, "token").select("pivot", "key").distinct()
    members = members.select(F.hex("pivot").alias("region"), "key")
    members = settled(members, "regions")

    todo, found = [], []
    for level in range(MAX_SPLITS + 1):
        sizes = settled(members.groupBy("region").agg(F.count("*").alias("size")), "region-sizes")
        todo.append(members.join(sizes.where(F.col("size") <= region_docs).select("region"), "region", "left_semi"))
        large = sizes.where(F.col("size") > region_docs)
        if large.isEmpty():
            break
        members = members.join(large.select("region"), "region", "left_semi")
        if level == MAX_SPLITS:
            todo.append(_tiles(members, large, region_docs))
            break
        pieces, tied = _split(members, reps, level, radius)
        pieces = settled(pieces, "regions")
        found.append(tied)
        # a split that leaves a piece nearly as large as its region gains nothing there
        parent = F.regexp_extract("region", "^(.*)/[^/]*$", 1)
        worst = pieces.groupBy("region").count().groupBy(parent.alias("region")).agg(F.max("count").alias("most"))
        stuck = large.join(worst, "region").where("4 * most > 3 * size").select("region", "size")
        todo.append(_tiles(members.join(stuck.select("region"), "region", "left_semi"), stuck, region_docs))
        members = pieces.withColumn("parent", parent).join(stuck.select(F.col("region").alias("parent")), "parent", "left_anti")
        members = settled(members.select("region", "key"), "regions")

    regions = todo[0]
    for more in todo[1:]:
        regions = regions.union(more)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = regions.join(reps, "key").select("region", "print", "n", "shingles")
    rows = rows.repartition(n, "region").sortWithinPartitions("region")
    joined = rows.mapInArrow(_join_regions(percent), "a binary, b binary")
    for tied in found:
        joined = joined.union(tied)
    return joined


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    percent: int = PERCENT,
    region_docs: int = REGION_DOCS,
) -> DataFrame:
    """Size of the shingle set and component of every document of ``docs``.

    One row a row of ``docs``: (doc_id, n_shingles, component_id). Two documents are
    linked when 100 * intersection >= percent * union of their sets of distinct
    5-word shingles, A-Z counted as a-z (with 1 to 4 words the whole sequence is the
    only shingle). ``component_id`` is the smallest id reachable by links. A text
    that is null, empty or without words has no shingle and only itself (its id) as
    component. Repeated rows are copies of each other; a null id gets the smallest
    id of its component, null if there is none. An empty table gives no rows;
    columns besides id and text are not read. ``docs`` should be a stored table
    (its rows must come in the same order if a task is repeated).
    """
    indexed = settled(index(docs, id_column, text_column, percent), "index")
    stars = components(links(indexed, percent, region_docs))
    sets = indexed.where("n > 0").groupBy("print").agg(F.min("id").alias("least"))
    named = sets.join(stars.withColumnRenamed("node", "print"), "print", "left")
    named = named.select("print", "least", F.coalesce("component", "print").alias("component"))
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(smallest, "component").select("print", "component_id")
    out = [F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id"]
    held = indexed.select("id", "n", "print").where("n > 0").join(named, "print").select(*out)
    return held.union(indexed.where("n = 0").withColumn("component_id", F.col("id")).select(*out))
