"""Spans of personal data against Python's regular expressions."""

import random
import re

from pyspark.sql import functions as F

from basketweave.llm import pii
from tests.llm.conftest import documents, with_clashes


def luhn(value):
    total = 0
    for i, c in enumerate(reversed(re.sub("[^0-9]", "", value))):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def count(value):
    return len(re.sub("[^0-9]", "", value))


# The contract's patterns and checks.
BASE = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        lambda m: all(int(p) <= 255 for p in m.split(".")),
    ),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= count(m) <= 19 and luhn(m)),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= count(m) <= 15),
}


def spans(text):
    found = [
        (m.start(), i, kind, m.end())
        for i, (kind, (pattern, good)) in enumerate(BASE.items())
        for m in re.finditer(pattern, text or "")
        if good(m[0])
    ]
    return ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in sorted(found))


def base_spans(df):
    base = F.filter("pii", lambda s: s["kind"].isin(pii.BASE))
    return [r[0] for r in df.orderBy("doc_id").select(pii.span_text(base)).collect()]


def test_agrees_with_the_base_patterns(spark):
    rng = random.Random(4)
    bits = [
        "a@b.c", "_d@e.f", "x.y@z", "@", ".", "é", "𝄞", " ", "-", "+", "1", "0", "256", "255.1.2.3",
        "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111111111111111", "+49 (30) 123-45 67",
        "+1234567890123456", "00000000001.2.3.4", "99999999999999999999.1.1.1", "word", "\n", "..",
    ]
    texts = ["".join(rng.choices(bits, k=rng.randint(1, 14))) for _ in range(1500)]
    assert base_spans(pii.find_pii(documents(spark, texts))) == [spans(t) for t in texts]


def test_validators_and_context(spark):
    texts = [
        "IBAN DE89 3704 0044 0532 0130 00 bank", "IBAN DE89 3704 0044 0532 0130 01",
        "my ssn 123-45-6789", "123-45-6789", "000-45-6789",
        "call +49 30 1234567", "+49 30 1234567",
    ]
    rows = pii.find_pii(documents(spark, texts)).orderBy("doc_id").collect()
    kinds = [[s["kind"] for s in r["pii"] if s["kind"] not in ("card",)] for r in rows]
    assert kinds == [["iban"], [], ["ssn"], ["ssn"], [], ["phone"], ["phone"]]
    score = [max((s["score"] for s in r["pii"]), default=0) for r in rows]
    assert score[2] > score[3] and score[5] > score[6]


def test_ibans_before_capitals_and_numbers(spark):
    german, british = "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32"
    expected = {
        f"IBAN {german} Please pay": [german],
        "DE89 3704 0044 0532 0130 00 Bank": ["DE89 3704 0044 0532 0130 00"],
        f"{british} 2024": [british],
        f"to {british} AND MORE CAPITALS FOLLOW 12": [british],
        f"{german} {british}": [german, british],
        f"AB12 3456 7890 1234 {german} X": [german],
        f"{german}X": [],
        f"{german}x": [],
        "MT84 MALT 0110 0001 2345 MTLC AST0 01S On": ["MT84 MALT 0110 0001 2345 MTLC AST0 01S"],
        f"{german} " * 600: [german] * 600,
    }
    docs = documents(spark, list(expected))
    rows = pii.find_pii(docs).orderBy("doc_id").collect()
    for row, (text, values) in zip(rows, expected.items(), strict=True):
        found = [s for s in row["pii"] if s["kind"] == "iban"]
        assert [s["value"] for s in found] == values, text
        assert all(text[s["start"] : s["end"]] == s["value"] for s in found)
    clean = [r["text"] for r in pii.redact(docs).orderBy("doc_id").collect()]
    assert clean[0] == "IBAN [IBAN] Please pay"


def test_redaction(spark):
    texts = ["write a@b.co or 10.0.0.1!", None, "", "née a@b.co"]
    rows = pii.redact(documents(spark, texts)).orderBy("doc_id").collect()
    assert [r["text"] for r in rows] == ["write [EMAIL] or [IP]!", None, "", "née [EMAIL]"]


def test_odd_rows(spark):
    long = ["7" * 200_000, "a" * 200_000, "1." * 100_000, "+" * 100_000, "a@" * 50_000, "x@y.z " * 3000]
    rows = [(0, None), (1, ""), (None, "a@b.c"), (2, "a@b.c"), (2, "a@b.c")]
    docs = with_clashes(documents(spark, [*rows, *((9 + i, t) for i, t in enumerate(long))]))
    found = pii.find_pii(docs)
    assert set(found.columns) == set(docs.columns)
    assert len(base_spans(found)) == len(rows) + len(long)
    sizes = {r["doc_id"]: len(r["pii"]) for r in found.collect()}
    assert sizes == {0: 0, 1: 0, None: 1, 2: 1, 9: 0, 10: 0, 11: 25_000, 12: 0, 13: 0, 14: 3000}
    assert pii.find_pii(docs.limit(0)).collect() == []
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()
