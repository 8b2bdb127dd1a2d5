"""Personal data: patterns propose spans, checksums confirm them, context scores them.

Proposals come from regular expressions. Card numbers must pass Luhn, bank account
numbers mod 97, addresses their number ranges. Kinds with such a proof, and the
base kinds, are always reported; a weak kind (a short card number, a dotted date)
only if words near it raise its score to the threshold.

Texts are searched whole, row by row in Arrow batches. Patterns start at the
border of a run and never give back what they matched, so time grows with the
length of a text and not with its square. An account number, of 43 characters at most,
may give back the groups after it, and the search goes on behind what was its own.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Base kinds in the order of reports. A search goes on from where the last match
#: ended (\\G) or from a place that no match can have passed.
EMAIL = regex.compile(r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
#: Further kinds: bank accounts (two letters, two check digits, groups), national
#: numbers in three groups, dates.
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
NATIONAL = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
BORN = re.compile(r"(?<![0-9.])[0-9]{1,2}[./][0-9]{1,2}[./](?:19|20)[0-9]{2}(?![0-9.])")
KINDS = ("email", "ip", "card", "phone", "iban", "short_card", "national", "born")
#: Score of a proposal, gain of a context word near it, and the score that counts.
PRIOR = {"iban": 0.9, "short_card": 0.5, "national": 0.4, "born": 0.2}
CONTEXT = {
    "short_card": "card|visa|amex|carte|karte|tarjeta|credit",
    "national": "ssn|social|security|tax|insurance",
    "born": "born|birth|dob|naissance|geboren|nacimiento|nacido",
}
NEAR = {kind: re.compile(rf"(?<![^\W\d_])(?:{words})(?:e?s)?(?![^\W\d_])", re.IGNORECASE) for kind, words in CONTEXT.items()}
GAIN, REPORTED, REACH = 0.4, 0.6, 48
DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    twice = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)
    return sum(twice[int(d)] if i % 2 else int(d) for i, d in enumerate(reversed(digits))) % 10 == 0


def mod97(account: str) -> bool:
    turned = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base finds by kind, then start; offsets in code points, end exclusive."""
    out = []
    if "@" in text:
        out += [("email", m.start(), m.end()) for m in EMAIL.finditer(text)]
    if not DIGIT.search(text):
        return out
    for m in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= len(DIGIT.findall(m[0])) <= 15]
    return out


def _account_end(run: str) -> int:
    """Where the account number at the start of ``run`` ends, 0 if there is none. Groups
    may be words that follow it, so ends before a space are tried too, the last first."""
    end = len(run)
    while end > 0:
        compact = run[:end].replace(" ", "")
        if 15 <= len(compact) <= 34 and mod97(compact):
            return end
        end = run.rfind(" ", 0, end)
    return 0


def _proposals(text: str) -> Iterator[tuple[str, int, int]]:
    at = 0
    while m := IBAN.search(text, at):
        end = _account_end(m[0])
        if end:
            yield "iban", m.start(), m.start() + end
        at = m.start() + (end or 4)
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 15 and luhn(digits):
            yield "short_card", m.start(), m.end()
    for kind, pattern in (("national", NATIONAL), ("born", BORN)):
        for m in pattern.finditer(text):
            yield kind, m.start(), m.end()


def more_spans(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int, float]]:
    """Further finds with scores. A proposal that touches a base find is part of that;
    of proposals that touch each other the one of higher score, then the first, stays."""
    if not DIGIT.search(text):
        return []
    scored = []
    for kind, start, end in _proposals(text):
        score = PRIOR[kind]
        if kind in NEAR and (NEAR[kind].search(text[max(0, start - REACH) : start]) or NEAR[kind].search(text[end : end + REACH])):
            score += GAIN
        if score >= REPORTED:
            scored.append((kind, start, end, score))
    taken = sorted((start, end) for _, start, end in base)
    out = []
    for found in sorted(scored, key=lambda s: (-s[3], s[1], KINDS.index(s[0]))):
        at = _place(taken, found[1])
        if (at == 0 or taken[at - 1][1] <= found[1]) and (at == len(taken) or taken[at][0] >= found[2]):
            taken.insert(at, (found[1], found[2]))
            out.append(found)
    return out


def _place(spans: list[tuple[int, int]], start: int) -> int:
    low, high = 0, len(spans)
    while low < high:
        mid = (low + high) // 2
        low, high = (mid + 1, high) if spans[mid][0] < start else (low, mid)
    return low


def listed(spans) -> str:
    return ",".join(f"{s[0]}:{s[1]}:{s[2]}" for s in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1])))


REPORT = T.StructType(
    [T.StructField(f"n_{kind}", T.LongType()) for kind in KINDS[:4]]
    + [T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())]
    + [T.StructField("scores", T.ArrayType(T.DoubleType()))]
)


def pii_report(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, scores) of every row.

    ``spans`` lists all finds as kind:start:end by kind, then start, ``base_sha256``
    is the sha-256 of the list of the base kinds alone; ``scores`` has the score of
    each find in ``spans`` (1.0 for base kinds). Null and empty texts have no finds.
    Rows are searched on their own: repeated rows, ties and null ids need no rule.
    Columns besides id and text are not read.
    """
    picked = docs.select("doc_id", text_column)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                base = base_spans(text or "")
                more = more_spans(text or "", base)
                counts = [sum(s[0] == kind for s in base) for kind in KINDS[:4]]
                order = sorted([(*s, 1.0) for s in base] + more, key=lambda s: (KINDS.index(s[0]), s[1]))
                digest = hashlib.sha256(listed(base).encode()).hexdigest()
                rows.append((*counts, digest, listed(order), [s[3] for s in order]))
            kinds = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.list_(pa.float64())]
            columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
            arrays = [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["doc_id", *REPORT.fieldNames()])

    return picked.mapInArrow(search, T.StructType([picked.schema["doc_id"], *REPORT.fields]))
