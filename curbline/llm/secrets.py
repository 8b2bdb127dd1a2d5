"""Secrets in texts: credential patterns, and credentials in several parts.

Three kinds of strong finds stand alone (``assign``, ``access``, ``hex``). Weak
candidates mean little by themselves: an account identifier, a short password, an
endpoint. Each part has a role (identifier, secret, endpoint) and a scope, the
text within ``reach`` code points of it. An interval join of parts and scopes
reports a weak candidate only where a part of another role lies in its scope.

All of it is built-in functions. A pattern cuts a text into gaps and hits, whose
lengths give code-point offsets; offsets are summed in slices, so time grows with
the number of hits. Only texts that hold a hint of a kind are cut by its pattern.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline.llm.names import quoted
from curbline.session import settled

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: kind, role, hint, pattern, what a hit must satisfy; strong kinds in order, then weak ones.
STRONG = [
    ("assign", "secret", r"(?i)password|passwd|secret|token|api_?key", ASSIGN, lambda hit: F.length(F.regexp_extract(hit, ASSIGN, 2)) >= 12),
    ("access", "identifier", "AKIA", r"AKIA[A-Z0-9]+", lambda hit: F.length(hit) >= 18),
    ("hex", "secret", "[0-9a-f]{16}", r"[0-9a-f]{16,}+", lambda hit: F.lit(True)),
]
WEAK = [
    ("identity", "identifier", r"(?i)(?:client|account|tenant|key)_?id|user_?name", r"""(?i:(?:client|account|tenant|key)_?id|user_?name)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{4,}+""", lambda hit: F.lit(True)),
    ("short", "secret", r"(?i)password|passwd|pwd|secret|token|api_?key", r"""(?i:password|passwd|pwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6,}+""", lambda hit: F.lit(True)),
    ("endpoint", "endpoint", "://", r"""[a-z][a-z0-9+]{1,14}+://[A-Za-z0-9._~:/?#@!$&()*+,;=%-]++""", lambda hit: F.lit(True)),
]
REACH = 200
SLICE = 256
SPAN = "array<struct<start:bigint,end:bigint,rank:int,kind:string,role:string>>"
MASK = "[SECRET]"


def _found(text: Column, rank: int, kind: str, role: str, hint: str, pattern: str, keep) -> tuple[Column, str]:
    """Gaps and hits of a pattern; and the expression that makes spans of them."""
    cut = F.zip_with(
        F.split(text, pattern, -1),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda gap, hit: F.struct(
            F.length(gap).alias("gap"), F.length(hit).alias("hit"), keep(hit).alias("ok")
        ),
    )
    cut = F.when(F.rlike(text, F.lit(hint)), F.filter(cut, lambda x: x["hit"].isNotNull()))
    cuts = f"cut_{kind}"
    part = f"slice({cuts}, c * {SLICE} + 1, {SLICE})"
    slices = f"sequence(0, (size({cuts}) - 1) div {SLICE})"
    sums = f"transform({slices}, c -> aggregate({part}, 0L, (n, x) -> n + x.gap + x.hit))"
    before = f"aggregate({sums}, array(0L), (a, n) -> array_append(a, element_at(a, -1) + n))"
    spans = f"""CASE WHEN size({cuts}) > 0 THEN flatten(zip_with({slices}, {before}, (c, base) -> IF(c IS NULL, NULL,
        aggregate({part}, struct(base AS at, CAST(array() AS {SPAN}) AS spans), (s, x) -> struct(
            s.at + x.gap + x.hit AS at,
            IF(x.ok, array_append(s.spans, struct(s.at + x.gap AS start, s.at + x.gap + x.hit AS end,
                {rank} AS rank, '{kind}' AS kind, '{role}' AS role)), s.spans) AS spans), s -> s.spans))))
        ELSE CAST(array() AS {SPAN}) END"""
    return cut.alias(cuts), spans.replace("flatten(zip_with", "flatten(filter(zip_with", 1).replace("s -> s.spans))))", "s -> s.spans))), x -> x IS NOT NULL))", 1)


def with_parts(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` and columns ``strong`` and ``weak``, in place of columns of these names:
    all spans of either sort, by start and kind. No shuffle; null text has none."""
    text = F.col(quoted(text_column))
    found = [_found(text, rank, *kind) for rank, kind in enumerate(STRONG + WEAK)]
    kept = [c for c in docs.columns if c.lower() not in ("strong", "weak")]
    cut = docs.select(F.struct(*[F.col(quoted(c)) for c in kept]).alias("row"), *[c for c, _ in found])
    exprs = [e for _, e in found]
    strong, weak = (f"array_sort(concat({', '.join(part)}))" for part in (exprs[: len(STRONG)], exprs[len(STRONG) :]))
    return cut.select(*[F.col(quoted(c, "row")).alias(c) for c in kept], F.expr(strong).alias("strong"), F.expr(weak).alias("weak"))


def find_secrets(docs: DataFrame, text_column: str = "text", reach: int = REACH) -> DataFrame:
    """(doc_id, text_hash, strong, linked): of every row the strong spans and the weak
    ones that a part of another role completes.

    Offsets are code points, the end exclusive. A weak candidate that overlaps a
    strong find is that find's, not a part of its own. Null and empty texts have no
    spans; repeated rows have the same spans each, and rows of one id with different
    texts are told apart by ``text_hash``. Columns besides id and text are not read.
    """
    picked = docs.select("doc_id", F.col(quoted(text_column)).alias("text"))
    parts = with_parts(picked).select("doc_id", F.xxhash64("text").alias("text_hash"), "strong", "weak")
    overlap = "filter(weak, w -> NOT exists(strong, s -> s.start < w.end AND w.start < s.end))"
    parts = settled(parts.withColumn("weak", F.when(F.size("weak") > 0, F.expr(overlap)).otherwise(F.col("weak"))), "parts")
    row = ["doc_id", "text_hash"]
    open_rows = parts.where("size(weak) > 0")
    spans = open_rows.select(*row, F.explode(F.concat("strong", "weak")).alias("part")).distinct()
    # a part lies in the cells its span touches; a scope reaches over whole cells
    cell = 4 * reach
    placed = spans.withColumn("cell", F.explode(F.expr(f"sequence(part.start div {cell}, part.end div {cell})")))
    weak = open_rows.select(*row, F.explode("weak").alias("weak")).distinct()
    scopes = weak.withColumn("cell", F.explode(F.expr(f"sequence(greatest(0, weak.start - {reach}) div {cell}, (weak.end + {reach}) div {cell})")))
    near = (
        (F.col("w.text_hash") == F.col("p.text_hash")) & F.col("w.doc_id").eqNullSafe(F.col("p.doc_id"))
        & (F.col("w.cell") == F.col("p.cell")) & (F.col("weak.role") != F.col("part.role"))
        & (F.col("part.start") <= F.col("weak.end") + reach) & (F.col("part.end") >= F.col("weak.start") - reach)
    )
    linked = scopes.alias("w").join(placed.alias("p"), near, "left_semi").select(*row, "weak").distinct()
    linked = linked.groupBy(*row).agg(F.array_sort(F.collect_list("weak")).alias("linked"))
    same = (F.col("a.text_hash") == F.col("b.text_hash")) & F.col("a.doc_id").eqNullSafe(F.col("b.doc_id"))
    empty = F.expr(f"CAST(array() AS {SPAN})")
    joined = open_rows.select(*row, "strong").alias("a").join(linked.alias("b"), same, "left")
    joined = joined.select("a.doc_id", "a.text_hash", "a.strong", F.coalesce("b.linked", empty).alias("linked"))
    return parts.where("size(weak) = 0").select(*row, "strong", empty.alias("linked")).union(joined)


def _listed(spans: str) -> Column:
    return F.expr(f"array_join(transform({spans}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')")


def secret_report(docs: DataFrame, text_column: str = "text", reach: int = REACH) -> DataFrame:
    """One row a row of ``docs``: doc_id, number of strong finds by kind,
    sha-256 of their list, and the list of all spans, by start and kind."""
    found = find_secrets(docs, text_column, reach)
    counts = [F.expr(f"CAST(size(filter(strong, s -> s.kind = '{k[0]}')) AS bigint) AS n_{k[0]}") for k in STRONG]
    digest = F.sha2(_listed("strong").cast("binary"), 256)
    return found.select("doc_id", *counts, digest.alias("base_sha256"), _listed("array_sort(concat(strong, linked))").alias("spans"))


def redacted(docs: DataFrame, text_column: str = "text", reach: int = REACH) -> DataFrame:
    """``docs`` with every reported span replaced by a mask; other rows unchanged."""
    found = find_secrets(docs, text_column, reach).select("doc_id", "text_hash", F.array_sort(F.concat("strong", "linked")).alias("spans"))
    found = found.where("size(spans) > 0").distinct().alias("f")
    own = F.col(quoted(text_column, "d"))
    same = F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.xxhash64(own) == F.col("f.text_hash"))
    joined = docs.alias("d").join(found, same, "left")
    masked = F.expr(f"""aggregate(f.spans, struct(0L AS at, CAST(array() AS array<string>) AS pieces), (s, x) -> IF(x.start < s.at,
        struct(greatest(s.at, x.end) AS at, s.pieces AS pieces),
        struct(x.end AS at, concat(s.pieces, array(substring({quoted(text_column, 'd')}, CAST(s.at + 1 AS int), CAST(x.start - s.at AS int)), '{MASK}')) AS pieces)),
        s -> concat(array_join(s.pieces, ''), substring({quoted(text_column, 'd')}, CAST(s.at + 1 AS int))))""")
    text = F.when(F.col("f.spans").isNull(), own).otherwise(masked)
    return joined.select(*[text.alias(c) if c == text_column else F.col(quoted(c, "d")) for c in docs.columns])
