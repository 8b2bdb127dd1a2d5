"""Mixing sources to target weights, block by block.

The words of a source, its documents in a fixed order, are packed into blocks of
``block_words`` words. Every source gets a quota of blocks that meets its target.
The mix is a row of shards with ``shard_slots`` slots each. The sources of a
shard's slots are a multinomial draw given the quotas: slot numbers of all sources
are laid end to end and put in a pseudorandom order that is cut into shards, so a
shard's counts vary as in independent draws while each source's total is met
exactly. Slot k of a source takes block ``p(k mod n)``, p being the source's own
pseudorandom permutation of its n blocks: no block is taken a second time before
all have been taken once. Slots find their blocks by a join on (source, block).

Permutations are computed, not sorted: "swap or not" rounds (Hoang, Morris and
Rogaway, 2012) map any index below n by hashes alone. Built-in functions only.
Offsets of words come from sums over chunks of a source, so a source that holds a
third of all rows is spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbline.llm.names import quoted
from curbline.session import settled

#: Words of a text: runs of anything but space and tab to carriage return.
WORD = r"[^\x20\x09-\x0D]++"
WEIGHTS, SHARE, REPEATS = (3, 1, 2), 1.5, 2
BLOCK_WORDS, SHARD_SLOTS, SEED = 64, 1024, 17
#: Chunks a source's documents are dealt to for summing; slots made by one task row.
CHUNKS, SLOTS_A_ROW, ROUNDS = 4096, 16384, 24


def permuted(k: Column, n: Column, key: Column, rounds: int = ROUNDS) -> Column:
    """Index k below n under the permutation of [0, n) that ``key`` names."""

    def swap(x: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(key, r), n) - x, n)
        return F.when(F.xxhash64(key, r, F.greatest(x, other)) % 2 == 0, x).otherwise(other)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), k.cast("long"), swap)


def sized(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """(doc_id, source, text_hash, size): size in words, 0 for a null text."""
    text = F.col(text_column)
    size = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select("doc_id", F.col("source").cast("string").alias("source"), F.xxhash64(text).alias("text_hash"), size.alias("size"))


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """(rank, source, source_size, target) of every source, null included.

    Sources in code-point order, null last, have the weights in turn. They share
    ``share`` times all sizes by weight; a target stops at ``repeats`` times its
    source's size and the excess goes to the others by weight, until none is above.
    In closed form: with sources ordered by limit over weight, the first of them
    that its share of what is left does not fill sets the level of all after it.
    One row a source; the windows see no documents.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy()
    ranked = sources.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") - 1) % len(weights) + 1)
    ranked = ranked.select("*", weight.alias("weight"), (F.lit(float(repeats)) * F.col("source_size")).alias("limit"))
    ranked = ranked.withColumn("ratio", F.col("limit") / F.col("weight"))
    by_ratio = Window.orderBy("ratio", "rank")
    full = F.coalesce(F.sum("limit").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    level = (F.lit(float(share)) * F.sum("source_size").over(everything) - full) / rest
    leveled = ranked.withColumn("level", level).withColumn("place", F.row_number().over(by_ratio))
    first = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("place", "level"))).over(everything)["level"]
    target = F.coalesce(F.least("limit", first * F.col("weight")), F.col("limit"))
    return leveled.select("rank", "source", "source_size", target.alias("target"))


def quotas(goals: DataFrame, block_words: int = BLOCK_WORDS, repeats: int = REPEATS) -> DataFrame:
    """``goals`` with blocks, quota (slots) and first_slot (in the row of all slots)."""
    blocks = F.ceil(F.col("source_size") / block_words).cast("long")
    passes = F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(repeats)).cast("long")
    rest = F.round((F.col("target") - passes * F.col("source_size")) / F.col("source_size") * blocks).cast("long")
    quota = F.when(F.col("source_size") > 0, F.least(passes * blocks + rest, blocks * repeats)).otherwise(F.lit(0))
    held = goals.select("*", blocks.alias("blocks"), quota.cast("long").alias("quota"))
    before = F.sum("quota").over(Window.orderBy("rank")) - F.col("quota")
    return held.select("*", before.alias("first_slot"), F.sum("quota").over(Window.partitionBy()).alias("slots"))


def drawn_slots(held: DataFrame, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """(shard, slot, rank, block, pass) of every slot of the output."""
    n = int(held.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    made = held.where("quota > 0").select("rank", "blocks", "quota", "first_slot", "slots")
    made = made.withColumn("part", F.explode(F.expr(f"sequence(0L, (quota - 1) div {SLOTS_A_ROW})"))).repartition(n, "rank", "part")
    span = F.expr(f"sequence(part * {SLOTS_A_ROW}, least((part + 1) * {SLOTS_A_ROW}, quota) - 1)")
    made = made.withColumn("k", F.explode(span))
    place = permuted(F.col("first_slot") + F.col("k"), F.col("slots"), F.lit(seed))
    block = permuted(F.col("k") % F.col("blocks"), F.col("blocks"), F.xxhash64(F.lit(seed), "rank"))
    made = made.select("rank", place.alias("place"), block.alias("block"), F.expr("k div blocks").alias("pass"))
    return made.select(F.expr(f"place div {shard_slots}").alias("shard"), (F.col("place") % shard_slots).alias("slot"), "rank", "block", "pass")


def shard_counts(docs: DataFrame, text_column: str = "text", block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """(shard, source, slots): how many slots of a shard the draw gives to a source. Over
    all shards they come to the source's quota; sources without slots have no row."""
    goals = settled(quotas(targets(settled(sized(docs, text_column), "sizes")), block_words), "targets")
    slots = drawn_slots(goals, shard_slots, seed).groupBy("shard", "rank").agg(F.count("*").alias("slots"))
    return slots.hint("merge").join(goals.select("rank", "source"), "rank").select("shard", "source", "slots")


def placed(sizes: DataFrame, goals: DataFrame) -> DataFrame:
    """``sizes`` with rank, source_size, target and ``first``, the number of words of
    its source before a document. Repeated rows follow each other."""
    chunked = sizes.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(CHUNKS)))
    chunks = chunked.groupBy("source", "chunk").agg(F.sum("size").alias("words"))
    before = chunks.withColumn("before", F.sum("words").over(Window.partitionBy("source").orderBy("chunk")) - F.col("words"))
    before = before.join(goals, before.source.eqNullSafe(goals.source)).select(before.source, "chunk", "before", "rank", "source_size", "target")
    inside = Window.partitionBy("source", "chunk").orderBy("doc_id", "text_hash", "size").rowsBetween(Window.unboundedPreceding, 0)
    c = chunked.withColumn("inside", F.sum("size").over(inside) - F.col("size")).alias("c")
    b = before.alias("b")
    same = F.col("c.source").eqNullSafe(F.col("b.source")) & (F.col("c.chunk") == F.col("b.chunk"))
    first = (F.col("before") + F.col("inside")).alias("first")
    return c.join(b, same).select("c.doc_id", "c.source", "c.text_hash", "c.size", "rank", "source_size", "target", first)


def taken_pieces(docs: DataFrame, text_column: str = "text", block_words: int = BLOCK_WORDS, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """The documents in place, and (rank, first, from, words, times, shards): how often
    the mix takes each piece of a document that lies in one block, and the shard of each
    time; from counts its words."""
    sizes = settled(sized(docs, text_column), "sizes")
    goals = settled(quotas(targets(sizes), block_words), "targets")
    located = settled(placed(sizes, goals), "placed")
    # a block has one slot a pass
    shards = F.array_compact(F.array(*[F.max(F.when(F.col("pass") == n, F.col("shard"))) for n in range(REPEATS)]))
    times = drawn_slots(goals, seed=seed).groupBy("rank", "block").agg(F.count("*").alias("times"), shards.alias("shards"))
    block = F.explode(F.expr(f"sequence(first div {block_words}, (first + size - 1) div {block_words})"))
    pieces = located.where("size > 0").select("rank", "first", "size", block.alias("block"))
    start, end = F.greatest("first", F.col("block") * block_words), F.least(F.col("first") + F.col("size"), (F.col("block") + 1) * block_words)
    pieces = pieces.select("rank", "first", "block", (start - F.col("first")).alias("from"), (end - start).alias("words"))
    # the plan takes exploded slots for as few as the sources they come from and would
    # broadcast them all
    return located, pieces.join(times.hint("merge"), ["rank", "block"])


def mix_report(docs: DataFrame, text_column: str = "text", block_words: int = BLOCK_WORDS, seed: int = SEED, shards: bool = False) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row of ``docs``, and on request
    ``shards``, the number of shards that words of the row are in.

    ``taken`` counts the words of a row that the mix takes, repeats included: at most
    twice its size, near the target over a source. Null and empty texts have size 0
    and are never taken. Repeated rows are rows of their own. A null source is a
    source, the last. The same rows give the same mix in any order and partitioning.
    Other columns are not read; an empty table gives no rows.
    """
    located, pieces = taken_pieces(docs, text_column, block_words, seed)
    sums = [F.sum(F.col("words") * F.col("times")).alias("taken")]
    if shards:
        sums.append(F.size(F.array_distinct(F.flatten(F.collect_list("shards")))).cast("long").alias("shards"))
    taken, names = pieces.groupBy("rank", "first").agg(*sums), ["taken", "shards"][: len(sums)]
    out = ["doc_id", "size", "source_size", "target"]
    filled = located.where("size > 0").join(taken, ["rank", "first"], "left").select(*out, *[F.coalesce(c, F.lit(0)).alias(c) for c in names])
    return filled.union(located.where("size = 0").select(*out, *[F.lit(0).cast("long").alias(c) for c in names]))


def mixed(docs: DataFrame, text_column: str = "text", block_words: int = BLOCK_WORDS, seed: int = SEED) -> DataFrame:
    """The mix as rows of ``docs``: a row for the words taken in a first pass and one
    for those taken again, each with exactly these words (and the white space after
    them) as text. Documents that are not taken have no row. The other columns stay as
    they are, whatever their names; they must be such that JSON can hold them."""
    located, pieces = taken_pieces(docs, text_column, block_words, seed)
    again = F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("pass")
    passes = pieces.select("rank", "first", "from", "words", again)
    passes = passes.groupBy("rank", "first", "pass").agg(F.array_sort(F.collect_list(F.struct("from", "words"))).alias("parts"))
    nth = Window.partitionBy("doc_id", "text_hash").orderBy("source", "first")
    numbered = located.where("size > 0").withColumn("nth", F.row_number().over(nth))
    wanted = numbered.join(passes, ["rank", "first"]).select("doc_id", "text_hash", "nth", "parts").alias("w")
    text = F.col(quoted(text_column))
    # rows of one id, text and source are told apart by their other columns
    row = F.struct(*[F.col(quoted(c)).alias(c) for c in docs.columns if c != text_column])
    own = docs.select(row.alias("row"), text.alias("text"), "doc_id", "source", F.xxhash64(text).alias("hash"), F.xxhash64(F.to_json(row)).alias("others"))
    own = own.where(F.rlike("text", F.lit(WORD)))
    own = own.withColumn("nth", F.row_number().over(Window.partitionBy("doc_id", "hash").orderBy("source", "others"))).alias("d")
    same = (F.col("d.hash") == F.col("w.text_hash")) & F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("d.nth") == F.col("w.nth"))
    words = F.regexp_extract_all(F.col("d.text"), F.lit(WORD + r"[\x20\x09-\x0D]*+"), F.lit(0))
    joined = own.join(wanted, same)

    def of_words(every: Column) -> Column:
        pieces = F.transform("w.parts", lambda p: F.array_join(F.slice(every, p["from"].cast("int") + 1, p["words"].cast("int")), ""))
        return F.array_join(pieces, "")

    # as a lambda's variable the words are cut once a row, not once a piece
    mixed_text = F.element_at(F.transform(F.array(words), of_words), 1)
    return joined.select(*[(mixed_text if c == text_column else F.col(quoted(c, "d.row"))).alias(c) for c in docs.columns])
