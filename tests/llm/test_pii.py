import hashlib
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from airsift.llm import pii
from texts import awkward, documents

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind, text):
    digits = [int(c) for c in text if c in "0123456789"]
    if kind == "ip":
        return all(int(part) <= 255 for part in text.split("."))
    if kind == "card":
        doubled = [d if place % 2 == 0 else sum(divmod(2 * d, 10)) for place, d in enumerate(digits[::-1])]
        return 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    return sorted(
        ((m.start(), m.end(), kind) for kind, pattern in PATTERNS.items() for m in re.finditer(pattern, text) if holds(kind, m.group())),
        key=lambda s: (s[0], list(PATTERNS).index(s[2])),
    )


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab@.-+% 0123456789()é\n", max_size=80))
def test_base_spans_equal_the_patterns(text):
    assert sorted(pii.base_spans(text), key=pii._order) == brute(text)


def test_added_spans():
    gap = " and then nothing that says anything for a good while "
    text = gap.join(["IBAN DE89 3704 0044 0532 0130 00 now", "SSN 123-45-6789.", "call 0301 234 5678.", "order 0301 234 5678", "+1 (212) 555-0123 4111111111111111"])
    spans = pii.added_spans(text, pii.base_spans(text))
    assert [(kind, text[s:e]) for s, e, kind in sorted(spans)] == [
        ("iban", "DE89 3704 0044 0532 0130 00"), ("ssn", "123-45-6789"), ("tel", "0301 234 5678"),
        ("phone", "+1 (212) 555-0123"), ("card", "4111111111111111"),
    ]
    assert pii.added_spans("IBAN DE88 3704 0044 0532 0130 00 and 123-45-6789", []) == []


def test_long_runs_and_many_spans():
    run = "7" * 300_000
    assert pii.base_spans(f"{run} 1.2.3.{run} 10.0.0.1.5.6.7.8") == [(600_008, 600_016, "ip"), (600_017, 600_024, "ip")]
    line = "call 0301 234 5678, SSN 123-45-6789, mail a@b.de or 10.0.0.1; "
    base = pii.base_spans(line * 5_000)
    added = pii.added_spans(line * 5_000, base)
    assert len(base) == len(added) == 10_000
    spans = sorted(base + added)
    assert all(before[1] <= after[0] for before, after in zip(spans, spans[1:]))


def test_query_and_mask(spark):
    rng = random.Random(1)
    rows = awkward(rng) + [
        (1, "write to a.b@c-d.org, or a@b; 10.0.0.256 10.0.0.25"), (2, "4111 1111 1111 1111 and +49 (30) 1234-5678"), (3, "+4111111111111111"), (4, "é x@y.zz"),
    ]
    docs = documents(spark, rows)
    got = sorted((str(r["doc_id"]), r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) for r in pii.personal_data(docs).collect())
    expected = []
    for doc_id, text in rows:
        spans = brute(text or "")
        joined = ",".join(f"{k}:{s}:{e}" for s, e, k in spans)
        expected.append((str(doc_id), *(sum(s[2] == k for s in spans) for k in PATTERNS), hashlib.sha256(joined.encode()).hexdigest()))
    assert got == sorted(expected)
    assert all(r["n_spans"] == (r["spans"].count(",") + 1 if r["spans"] else 0) for r in pii.personal_data(docs).collect())
    masked = pii.mask(docs)
    assert masked.columns == docs.columns and masked.dtypes == docs.dtypes and masked.count() == len(rows)
    texts = {r["doc_id"]: (r["text"], r["n_chars"]) for r in masked.collect()}
    assert texts[1] == ("write to <EMAIL>, or a@b; 10.0.0.256 <IP>", 41)
    assert texts[2][0] == "<CARD> and <PHONE>"
    assert texts[900] == (None, 0)
    assert pii.personal_data(documents(spark, [])).count() == 0 and pii.mask(documents(spark, [])).count() == 0
