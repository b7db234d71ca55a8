"""Personal data against plain patterns, and the kinds that anchors add."""

import hashlib
import random
import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import corpus as C
from ledgerlark.llm import personal

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(x) <= 255 for x in found.split("."))
    if kind == "card":
        twice = [int(d) * (1 + i % 2) for i, d in enumerate(digits[::-1])]
        return 12 <= len(digits) <= 19 and sum(x // 10 + x % 10 for x in twice) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def base(text):
    out = [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if passes(k, m.group())]
    return sorted(out, key=lambda s: (s[1], list(PATTERNS).index(s[0])))


def of_base(text):
    return [s for s in personal.personal_spans(text) if s[0] in PATTERNS]


PARTS = [
    "a@b.c@d.e", "x.y+z%1@mail-7.example.com", "@", "a@b", "1.2.3.4.5.6.7.8", "1.2.3.4.5.6.7", "256.1.1.1", "0001.02.3.4", "1.2.3.", "4111 1111 1111 1111",
    "4111-1111-1111-1111 1", "4111  1111", "+1 (415) 555-2671", "+49--3", "+1", "+1 ((((", "+12345678901234567", "é٣١@x.y", "١٢٣", "9" * 30, "+1 2 3 4 5 6 7 8 9.10.11.12",
    "1.1.1.1@1.1", "00000000000000000", "...@...", "a@-.-", "a@b..c", "+ 1", "++1 234 567 89",
]


def test_base_spans_equal_the_patterns():
    r = random.Random(5)
    for _ in range(3000):
        text = r.choice(["", " ", "é"]).join(r.choice([*PARTS, *"0123456789.@+- ()x"]) for _ in range(r.randrange(12)))
        assert of_base(text) == base(text), text


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="0123456789.@+- ()aZ%\né", max_size=60))
def test_base_spans_of_any_text(text):
    assert of_base(text) == base(text)


def test_added_kinds_and_their_borders():
    def told(text):
        return [(k, text[a:b]) for k, a, b in personal.personal_spans(text) if k not in PATTERNS]

    assert told("see https://jo:pw@host.example/x?y=1). now") == [("url", "https://jo:pw@host.example/x?y=1")]
    assert told("http://plain.example/ and ssh://[fe80::1]:22/") == [("url", "ssh://[fe80::1]:22/")]
    assert told("IBAN: DE89 3704 0044 0532 0130 00 please") == [("iban", "DE89 3704 0044 0532 0130 00")]
    assert told("iban DE88370400440532013000") == []
    assert told("Account no. 1234-567890, konto: AB12CD34; accounting 123456") == [("account", "1234-567890"), ("account", "AB12CD34")]
    assert told("the account was closed in 1999") == [] and told("account 12 345") == []


def test_rows_and_digests(spark):
    texts = C.awkward_texts() + PARTS + ["1 " * 20000 + "a@b.cd", "@" * 30000, "+" * 30000, "1.2.3.4 " * 4000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, "4111111111111111"), (None, "+1 (415) 555-2671")]
    docs = C.frame(spark, rows, kind=1, n_ip="x", start=2).repartition(3)
    got = sorted(personal.personal_digest(personal.find_personal(docs, ["doc_id"])).collect(), key=str)
    want = []
    for i, text in rows:
        own = base(text)
        said = ",".join(f"{k}:{a}:{b}" for k, a, b in own)
        counts = [sum(s[0] == k for s in own) for k in PATTERNS]
        want.append((i, *counts, hashlib.sha256(said.encode()).hexdigest(), said))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert personal.find_personal(C.frame(spark, []), ["doc_id"]).count() == 0
    with pytest.raises(ValueError):
        personal.find_personal(docs.withColumn("spans", F.lit(1)), ["spans"])


def test_redacted_texts(spark):
    rows = [(1, "é mail a@b.cd or +1 (415) 555-2671."), (2, "none"), (3, None), (4, "https://me@1.2.3.4/x end")]
    found = personal.find_personal(C.frame(spark, rows), ["doc_id", "text"])
    got = {r.doc_id: r.out for r in found.select("doc_id", personal.redacted(F.col("text"), F.col("spans")).alias("out")).collect()}
    assert got == {1: "é mail <EMAIL> or <PHONE>.", 2: "none", 3: None, 4: "<URL> end"}
