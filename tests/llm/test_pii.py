"""op6: against the plain patterns."""

import hashlib
import random
import re

from curbline.llm import pii


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base(text):
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    return out + [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


def test_base_spans_of_random_texts():
    draw = random.Random(9)
    for alphabet in ("ab1.@-%+ 0é", "0123456789 -.+()", "a@.%", "45 6-"):
        for _ in range(4000):
            text = "".join(draw.choice(alphabet) for _ in range(draw.randint(0, 90)))
            assert pii.base_spans(text) == base(text), text


def test_further_kinds():
    text = "IBAN GB82 WEST 1234 5698 7654 32, GB83 WEST 1234 5698 7654 32; amex 378282246310005 born 12.03.1987"
    assert [s[:3] for s in sorted(pii.more_spans(text, []), key=lambda s: s[1])] == [("iban", 5, 32), ("short_card", 68, 83), ("born", 89, 99)]
    assert pii.more_spans("378282246310005 or 12.03.1987 or 123-45-6789", []) == []
    assert [s[0] for s in pii.more_spans("ssn: 123-45-6789", [])] == ["national"]
    assert pii.more_spans("card 378282246310005", [("card", 5, 20)]) == []
    assert pii.mod97("DE89370400440532013000") and not pii.mod97("DE88370400440532013000")


def accounts(text):
    return [text[a:b] for kind, a, b, _ in sorted(pii.more_spans(text, []), key=lambda s: s[1]) if kind == "iban"]


def test_account_numbers_before_other_groups():
    spaced, plain, british = "ES91 2100 0418 4502 0005 1332", "ES9121000418450200051332", "GB82 WEST 1234 5698 7654 32"
    for account in (spaced, plain, british, "AT61 1904 3002 3457 3201", "BE68539007547034"):
        for after in ("", " BIC CAIXESBB", " 2024", " CAIXESBB", " A", " 2024 2025 ABCD EFGH", " today", ", 2024", " 12345678 1234"):
            assert accounts(f"IBAN {account}{after}") == [account], (account, after)
    for first in (spaced, plain, british):
        assert accounts(f"{first} {plain} {british} 2024") == [first, plain, british]
    assert accounts(f"AB12 CDEF GHIJ {british}") == [british]  # a failed proposal takes nothing along
    assert accounts(f"{spaced[:-1]}3 BIC") == accounts(f"{plain}BIC") == accounts(f"X{plain} BIC") == []


def test_long_runs_take_linear_time():
    for text in ("a" * 400_000 + "@", "1" * 400_000 + ".1" * 300_000, "+1" + "(" * 400_000, "a@" * 200_000):
        pii.base_spans(text)


def test_many_account_proposals_take_linear_time():
    for text in ("AB12 " * 80_000, "AB12CDEF" * 50_000, "AB12 CDEF GHIJ KLMN " * 20_000):
        assert pii.more_spans(text, []) == []


def test_report(spark, odd_docs, no_docs):
    texts = ["a@b.example %x@c.example", "\U0001f600 é 10.0.0.255 and 10.0.0.256", "4111 1111 1111 1111", "+49 (30) 1234567"]
    docs = odd_docs.select("doc_id", "text").union(spark.createDataFrame(list(enumerate(texts, 60)), "doc_id long, text string"))
    out = pii.pii_report(docs)
    assert out.columns[:7] == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    want = []
    for d in docs.collect():
        spans = base(d.text or "")
        digest = hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
        want.append((d.doc_id or -1, *(sum(s[0] == k for s in spans) for k in pii.KINDS[:4]), digest))
    rows = out.collect()
    assert sorted((r.doc_id or -1, *r[1:6]) for r in rows) == sorted(want)
    assert all(len(r.scores) == len([s for s in r.spans.split(",") if s]) for r in rows)
    assert pii.pii_report(no_docs).count() == 0
