"""Conversations with typed content as one marked-up string each.

A message has a role and an ordered list of parts (text, image, audio, document).
A visitor over the parts of each message flattens them: a text part contributes its
escaped text, any other part a placeholder in its place, while its reference and
the number of tokens the placeholder expands to are recorded. Messages are joined
in the order of their turns, with the text spans that count towards a loss.

Marks of the template and other control strings never survive inside texts: a
backslash becomes ``\\0`` and the i-th control string ``\\i``, so no text can open
or close a turn, and ``unescaped`` gives the text back. Built-in functions only.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Marks of the template: start of a turn, end of its role, end of a turn, placeholder.
OPEN, BODY, CLOSE, SLOT = "<|turn|>", "<|body|>", "<|end|>", "<|slot:"
#: Strings that must not survive in a text; the first covers all marks of the
#: template, the others are control strings of common chat templates.
CONTROL = ("<|", "|>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<s>", "</s>")
#: Edge of an image patch, seconds of audio and pages a token stands for.
PATCH, AUDIO_TOKENS_A_SECOND, PAGE_TOKENS = 14, 25, 256
#: Code points of a slice of a text that spans are read from.
SLICE = 4096

PART = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("text", T.StringType()), T.StructField("ref", T.StringType()),
    T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType()),
    T.StructField("seconds", T.DoubleType()), T.StructField("pages", T.IntegerType()),
])

assert len(CONTROL) <= 9 and not any("\\" in c or c[0].isdigit() for c in CONTROL)


def escaped(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\0"))
    for i, control in enumerate(CONTROL, 1):
        text = F.replace(text, F.lit(control), F.lit(f"\\{i}"))
    return text


def unescaped(text: Column) -> Column:
    for i, control in reversed(list(enumerate(CONTROL, 1))):
        text = F.replace(text, F.lit(f"\\{i}"), F.lit(control))
    return F.replace(text, F.lit("\\0"), F.lit("\\"))


def text_part(text: Column) -> Column:
    """A text as the only part of a message."""
    fields = [F.lit("text"), text, *[F.lit(None)] * 5]
    return F.array(F.struct(*[c.cast(f.dataType).alias(f.name) for c, f in zip(fields, PART.fields, strict=True)]))


def expanded_tokens(part: Column) -> Column:
    """Tokens a placeholder stands for; 0 for a text and for unknown measures."""
    patches = F.ceil(part["width"] / PATCH) * F.ceil(part["height"] / PATCH)
    count = (
        F.when(part["kind"] == "image", patches)
        .when(part["kind"] == "audio", F.ceil(part["seconds"] * AUDIO_TOKENS_A_SECOND))
        .when(part["kind"] == "document", part["pages"] * PAGE_TOKENS)
    )
    return F.coalesce(count.cast("long"), F.lit(0).cast("long"))


def visited(parts: Column) -> Column:
    """Text of the parts of one message in order, with placeholders."""

    def visit(part: Column) -> Column:
        placeholder = F.concat(F.lit(SLOT), F.coalesce(escaped(part["kind"]), F.lit("unknown")), F.lit("|>"))
        return F.when(part["kind"] == "text", F.coalesce(escaped(part["text"]), F.lit(""))).otherwise(placeholder)

    return F.array_join(F.transform(parts, visit), "")


def attachments(parts: Column) -> Column:
    """What the placeholders of one message stand for, in order."""
    others = F.filter(parts, lambda p: ~p["kind"].eqNullSafe(F.lit("text")))
    return F.transform(others, lambda p: F.struct(p["kind"].alias("kind"), p["ref"].alias("ref"), expanded_tokens(p).alias("tokens")))


def formatted(messages: DataFrame, loss_roles=("assistant",)) -> DataFrame:
    """One row a conversation of ``messages`` (conv_id, turn, role, parts): conv_id,
    text, loss (spans of ``text`` under the loss mask, in code points, end exclusive),
    segments (text under the mask, span by span), attachments (turn, kind, ref,
    tokens; in the order of the placeholders) and expanded_tokens (their sum).

    Messages come by turn, null first; ties by role, then content, and repeated rows
    follow each other. A null role or content is empty, a null part and a part of
    unknown kind a placeholder. A null conv_id is a conversation. Other columns are
    not read.
    """
    body = F.coalesce(visited(F.col("parts")), F.lit(""))
    rows = messages.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), body.alias("body"), F.coalesce(attachments(F.col("parts")), F.expr("CAST(array() AS array<struct<kind:string,ref:string,tokens:bigint>>)")).alias("held"))
    head = F.concat(F.lit(OPEN), escaped(F.col("role")), F.lit(BODY))
    rows = rows.select("*", head.alias("head"), F.col("role").isin(*loss_roles).alias("counts"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "body")
    size = F.length("head") + F.length("body") + len(CLOSE)
    before = F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, 0)) - size
    rows = rows.withColumn("at", F.row_number().over(order)).withColumn("start", before + F.length("head"))
    turn = F.struct("at", "turn", "start", "head", "body", "counts", "held")
    talk = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    scored = F.filter("turns", lambda t: t["counts"])
    listed = F.flatten(F.transform("turns", lambda t: F.transform(t["held"], lambda a: F.struct(t["turn"].alias("turn"), a["kind"].alias("kind"), a["ref"].alias("ref"), a["tokens"].alias("tokens")))))
    return talk.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE))), "").alias("text"),
        F.transform(scored, lambda t: F.struct(t["start"].alias("start"), (t["start"] + F.length(t["body"])).alias("end"))).alias("loss"),
        F.transform(scored, lambda t: t["body"]).alias("segments"),
        listed.alias("attachments"),
    ).withColumn("expanded_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"]))


def read_back(text: Column) -> Column:
    """Turns (role, text) of a formatted conversation, unescaped; placeholders stay."""
    pieces = F.filter(F.split(text, re.escape(OPEN), -1), lambda p: p != "")

    def turn(piece: Column) -> Column:
        at = F.instr(piece, F.lit(BODY))
        role = F.substring(piece, F.lit(1), at - 1)
        body = F.substring(piece, at + len(BODY), F.length(piece) - at - (len(BODY) + len(CLOSE)) + 1)
        return F.struct(unescaped(role).alias("role"), unescaped(body).alias("text"))

    return F.transform(pieces, turn)


def under_mask(text: Column, spans: Column) -> Column:
    """The parts of a formatted conversation that lie in ``spans``, unescaped. The text is
    cut into slices first, so that a span is not counted from the start of a long one."""
    slices = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{SLICE}}}"), F.lit(0))

    def cut(every: Column) -> Column:
        def part(s: Column) -> Column:
            first, last = F.floor(s["start"] / SLICE), F.floor((s["end"] - 1) / SLICE)
            near = F.array_join(F.slice(every, (first + 1).cast("int"), F.greatest(last - first + 1, F.lit(0)).cast("int")), "")
            return unescaped(F.substring(near, (s["start"] % SLICE + 1).cast("int"), (s["end"] - s["start"]).cast("int")))

        return F.transform(spans, part)

    # as a lambda's variable the text is cut once, not once a span
    return F.element_at(F.transform(F.array(slices), cut), 1)


def chat_report(messages: DataFrame) -> DataFrame:
    """Formats ``messages`` (conv_id, turn, role, text) and reads the outcome back: turns
    by the marks of the template, the loss by the spans of its mask."""
    parts = text_part(F.col("text"))
    done = formatted(messages.select("conv_id", "turn", "role", parts.alias("parts")))
    back = done.select("conv_id", "text", "loss", read_back(F.col("text")).alias("turns"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(under_mask(F.col("text"), F.col("loss")), "")
    back = back.select("conv_id", "text", F.size("turns").cast("long").alias("n_turns"), lines.alias("lines"), loss.alias("loss"))
    return back.select(
        "conv_id",
        "n_turns",
        F.sha2(F.col("lines").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("text").cast("long").alias("formatted_chars"),
    )
