import random
import re

import pytest

from adlake.llm import pii


def luhn(text):
    digits = [int(c) for c in text if c in "0123456789"]
    total = sum(d if n % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for n, d in enumerate(reversed(digits)))
    return 12 <= len(digits) <= 19 and total % 10 == 0


BASE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", luhn),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= sum(c in "0123456789" for c in s) <= 15),
]


def brute(text):
    found = [
        (m.start(), n, f"{kind}:{m.start()}:{m.end()}")
        for n, (kind, pattern, valid) in enumerate(BASE)
        for m in re.finditer(pattern, text)
        if valid(m.group())
    ]
    return ",".join(f[2] for f in sorted(found))


def base(text):
    return pii.joined([s for s in pii.find(text) if s.kind in pii.BASE])


def test_base_spans_equal_the_plain_patterns(documents):
    rng = random.Random(2)
    parts = ["a", "b.c", "@", "@", "a.b", "_", "%", "1", "12", "255", "256", ".", ".", "-", " ", "+", "+1", "(", ")",
             "4111111111111111", "5500005555555559", "é", "078-05-1120", "ssn ", "١", "\n", "0007", "9" * 20]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(30_000)]
    for text in texts + [r.text for r in documents.collect()]:
        assert base(text) == brute(text), repr(text)


def test_further_kinds_need_a_checksum_or_context():
    assert [s.kind for s in pii.find("DE89 3704 0044 0532 0130 00")] == ["iban"]
    assert pii.find("DE88 3704 0044 0532 0130 00") == []
    assert pii.find("number 078-05-1120") == []
    assert [s.kind for s in pii.find("SSN: 078-05-1120")] == ["ssn"]
    assert pii.find("ssn 000-05-1120") == []
    plain, near = pii.find("x 4111111111111111")[0], pii.find("card 4111111111111111")[0]
    assert near.score > plain.score


@pytest.mark.parametrize("number", ["DE89370400440532013000", "DE89 3704 0044 0532 0130 00", "NO93 8601 1117 947"])
@pytest.mark.parametrize("after", ["", " BIC COBADEFFXXX", " AND call", " 500 EUR", " I think", " 12 A 3 B", ", BIC X"])
@pytest.mark.parametrize("before", ["", "A ", "EUR 500 ", "to AB12 ", "PO12 3456 "])
def test_iban_among_capitals_and_numbers(before, number, after):
    spans = [s for s in pii.find(before + number + after) if s.kind == "iban"]
    assert [(s.start, s.end) for s in spans] == [(len(before), len(before + number))]
    assert number not in pii.masked(before + number + after)


def test_several_ibans_in_a_row():
    number = "GB82 WEST 1234 5698 7654 32"
    assert pii.masked(f"{number} {number} AND {number}") == "[IBAN] [IBAN] AND [IBAN]"
    assert pii.find("DE88 3704 0044 0532 0130 00 BIC COBADEFFXXX") == []


def test_context_words_after_a_span():
    assert [s.kind for s in pii.find("078-05-1120 (SSN)")] == ["ssn"]
    assert pii.masked("078-05-1120 is my social security number") == "[SSN] is my social security number"
    assert pii.find("078-05-1120" + " " * 60 + "ssn") == []


def test_masking():
    assert pii.masked("to a@b.co, +1 (017) 555-7713!") == "to [EMAIL], [PHONE]!"
    assert pii.masked("no data") == "no data"


@pytest.mark.parametrize("unit", ["1", "a", "a@", "+1 ", "1.", "1-", "AA11", "a.b@c", "AA11 ", "+1" + " " * 50])
def test_long_texts_take_linear_time(unit):
    pii.find(unit * (300_000 // len(unit)))


def test_odd_rows_and_empty(odd_docs, no_docs):
    rows = pii.summarize(odd_docs).collect()
    texts = {str(r.doc_id): r.text for r in odd_docs.collect() if r.doc_id is not None}
    assert len(rows) == 13
    for r in rows:
        if r.doc_id is not None:
            assert (r.n_email, r.n_card) == ((1, 1) if r.doc_id in (1, 2) else (0, 0))
            assert r.spans == pii.joined(pii.find(texts[str(r.doc_id)] or ""))
    out = pii.mask(odd_docs)
    assert out.schema == odd_docs.schema
    for r in out.collect():
        assert r.n_chars == (None if r.text is None else len(r.text)) and r.row == "row"
        assert r.text is None or "@" not in r.text
    spans = {r.doc_id: r.spans for r in pii.detect(odd_docs).collect()}
    assert [s.kind for s in spans[1]] == ["email", "card"] and spans[3] == []
    assert pii.mask(no_docs).count() == pii.summarize(no_docs).count() == 0
