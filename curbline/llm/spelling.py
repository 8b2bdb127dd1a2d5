"""Spelling variants by composition of finite-state machines.

The vocabulary is an acceptor A, minimised; T is the transducer of exactly one
inserted, deleted or replaced code point. The words at one edit from each other are
the pairs that A composed with T composed with A accepts. States of the composition
are (state of A, edit used, state of A). Until the edit both sides have read the same,
so their states agree; after it only strings accepted from both states lead on.

Pairs are enumerated in partitions of the initial state: those whose edit lies in
one span of positions agree before and behind it, so words are dealt by what lies
outside a span, and a task holds the acceptor of one such part at a time. Parts of too many
words, or too wide a span, have their span halved again, so that no part outgrows a
task: with a span of one position a part has at most one word per code point or pair
of them. The edit of a pair counts as lying behind the longest common prefix, so each
pair comes out of exactly one part, once.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.session import settled

MIN_LENGTH, MIN_COUNT, NOISE = 5, 3, 97
#: Words of a part, and positions of its span, from which on it is halved.
PART_WORDS, SPAN = 20_000, 64
#: A form has this many times the occurrences of its variant, at least.
RATIO = 2
#: Different words that a task counts before it sends them on.
COUNTED = 200_000
RUN = re.compile("[a-zÀ-ÿ]+")
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
KEY = ["size", "start", "end", "before", "behind"]


def counted_words(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, noise: int = NOISE) -> DataFrame:
    """(word, n): words of ``docs`` (doc_id, text) of at least ``min_length`` code points
    and ``min_count`` occurrences in all texts, which are read whole.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, with only A-Z lower-cased.
    Where ``noise`` divides the crc32 of ``<doc_id>:<word>`` the word loses the code point
    at crc32 modulo its length (0: none does). Null texts have no words; a null id counts
    as an empty string. Other columns are not read.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()

        def flushed() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], ["word", "n"])
            found.clear()
            return out

        for batch in batches:
            for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
                own = Counter(RUN.findall(raw.as_py().translate(LOWER).decode()))
                start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for word, n in own.items():
                    h = zlib.crc32(word.encode(), start) if noise else 1
                    if noise and h % noise == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                    if len(word) >= min_length:
                        found[word] += n
                if len(found) >= COUNTED:
                    yield flushed()
        yield flushed()

    texts = docs.select("doc_id", "text").where("text IS NOT NULL")
    counted = texts.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= min_count)


class Acceptor:
    """The minimal acceptor of some words. States with the same strings ahead of them
    are one state; ``arcs`` has the next state by letter, ``final`` tells where words end."""

    def __init__(self, words: list[str]):
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        self._known: dict[tuple, int] = {}
        self._ahead: dict[int, list[str]] = {}
        self._common: dict[tuple[int, int], list[str]] = {}
        self.initial = self._state(sorted(set(words)), 0)

    def _state(self, words: list[str], depth: int) -> int:
        final = bool(words) and len(words[0]) == depth
        arcs = {c: self._state(list(some), depth + 1) for c, some in groupby(words[final:], key=lambda w: w[depth])}
        kind = (final, *arcs.items())
        if kind not in self._known:
            self._known[kind] = len(self.arcs)
            self.arcs.append(arcs)
            self.final.append(final)
        return self._known[kind]

    def ahead(self, state: int) -> list[str]:
        """All strings accepted from a state."""
        if state not in self._ahead:
            strings = [""] if self.final[state] else []
            strings += [c + rest for c, then in self.arcs[state].items() for rest in self.ahead(then)]
            self._ahead[state] = strings
        return self._ahead[state]

    def common(self, p: int, q: int) -> list[str]:
        """Strings accepted from both states: what follows once the edit is used."""
        if p == q:
            return self.ahead(p)
        key = (p, q) if p < q else (q, p)
        if key not in self._common:
            strings = [""] if self.final[p] and self.final[q] else []
            few, many = (p, q) if len(self.arcs[p]) < len(self.arcs[q]) else (q, p)
            for c, then in self.arcs[few].items():
                if c in self.arcs[many]:
                    strings += [c + rest for rest in self.common(then, self.arcs[many][c])]
            self._common[key] = strings
        return self._common[key]

    def one_edit(self, width: int) -> list[tuple[str, str]]:
        """Pairs of words of one edit at a position below ``width``, each once: the first
        word has the greater letter there or one letter more."""
        seen: dict[tuple[int, int], list[tuple[str, str]]] = {}

        def pairs(state: int, depth: int) -> list[tuple[str, str]]:
            if depth >= width:
                return []
            if (state, depth) not in seen:
                out, arcs = [], self.arcs[state].items()
                for c, then in arcs:
                    out += [(c + x, c + y) for x, y in pairs(then, depth + 1)]
                    # c deleted; what follows must not begin with c, or a later one is the edit
                    out += [(c + rest, rest) for rest in self.common(then, state) if rest[:1] != c]
                    for d, other in arcs:
                        if d < c and (rest := self.common(then, other)):
                            out += [(c + r, d + r) for r in rest]
                seen[state, depth] = out
            return seen[state, depth]

        return pairs(self.initial, 0)


def _halved(parts: DataFrame) -> DataFrame:
    """Both halves of the span of every row: it is dealt by what lies outside of them."""
    middle = F.floor((F.col("start") + F.col("end")) / 2).cast("int")
    halves = F.array(F.struct("start", middle.alias("end")), F.struct(middle.alias("start"), "end"))
    out = parts.select("word", "n", "size", F.explode(halves).alias("half")).select("word", "n", "size", "half.start", "half.end")
    kept = F.greatest(F.col("size") - F.col("end"), F.lit(0))
    before, behind = F.expr("substring(word, 1, start)"), F.when(kept > 0, F.substring("word", -kept, kept)).otherwise("")
    return out.select("word", "n", "size", "start", "end", before.alias("before"), behind.alias("behind"))


def near_words(vocabulary: DataFrame, part_words: int = PART_WORDS, span: int = SPAN) -> DataFrame:
    """(word, near, near_n): for each word of ``vocabulary`` (word, n; words are not null
    and appear once) all words at exactly one edit from it, and their n."""
    spark = vocabulary.sparkSession
    # a pair of lengths L and L, or L and L + 1, belongs to size L; its edit is at 0 to L
    size = F.length("word")
    rows = vocabulary.where("word IS NOT NULL").select("word", "n", F.explode(F.array(size, size - 1)).alias("size")).where("size >= 0")
    open_ = rows.select("word", "n", "size", F.lit(0).alias("start"), (F.col("size") + 1).alias("end"))
    closed = None
    while True:
        parts = settled(_halved(open_), "parts")
        many = parts.groupBy(*KEY).agg(F.count("*").alias("words")).where("words > 1")
        parts = settled(parts.join(many, KEY), "parts")
        wide = (F.col("end") - F.col("start") > 1) & ((F.col("words") > part_words) | (F.col("end") - F.col("start") > span))
        small = parts.where(~wide).drop("words")
        closed = small if closed is None else closed.union(small)
        open_ = parts.where(wide)
        if open_.isEmpty():
            break

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in (*KEY, "word", "n")), strict=True))
        for (size, start, end, before, behind), part in groupby(rows, key=lambda row: row[:5]):
            words = {word[start : len(word) - len(behind)]: n for *_, word, n in part}
            least = size - start - len(behind)
            found = [(x, y) for x, y in Acceptor(list(words)).one_edit(end - start) if len(y) == least]
            if found:
                found += [(y, x) for x, y in found]
                left, right, n = ([f(p) for p in found] for f in (lambda p: before + p[0] + behind, lambda p: before + p[1] + behind, lambda p: words[p[1]]))
                yield pa.RecordBatch.from_arrays([pa.array(left, pa.string()), pa.array(right, pa.string()), pa.array(n, pa.int64())], ["word", "near", "near_n"])

    dealt = closed.select(*KEY, "word", F.col("n").cast("long").alias("n"))
    dealt = dealt.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *KEY).sortWithinPartitions(*KEY)
    return dealt.mapInArrow(compose, "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): from each word of ``forms`` (word, form; neither null, without
    circles) along forms to the last, by doubling the steps."""
    paths = settled(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = paths.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = paths.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        longer = settled(longer, "roots")
        paths = longer.drop("moved")
        if longer.where("moved").isEmpty():
            return paths


def spelling_groups(vocabulary: DataFrame, ratio: int = RATIO, part_words: int = PART_WORDS, span: int = SPAN) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``vocabulary`` (word, n).

    n_near counts the words at one inserted, deleted or replaced code point. The form is
    the one of these with the largest n, of equal ones the first in code-point order, if
    its n is at least ``ratio`` (over 1) times the word's; else null. The root is the
    last word along forms, or the word itself. Words appear once; rows of a null word are
    left out. Other columns are not read; an empty table gives no rows.
    """
    vocabulary = settled(vocabulary.select("word", F.col("n").cast("long").alias("n")).where("word IS NOT NULL"), "vocabulary")
    near = near_words(vocabulary, part_words, span)
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("best"))
    found = vocabulary.join(best, "word", "left").withColumn("is_form", -F.col("best.n") >= ratio * F.col("n"))
    found = found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(F.col("is_form"), F.col("best.near")).alias("form"), F.when(F.col("is_form"), -F.col("best.n")).alias("form_n"))
    found = settled(found, "variants")
    ends = roots(found.where("form IS NOT NULL"))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
