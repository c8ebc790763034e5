"""Personal data: patterns propose spans, checksums confirm them, words nearby move the score.

A kind has a pattern, a validator and context words. Its score is a start value, plus a bonus
where a checksum confirms it, plus a bonus where a context word stands within the words just
before or after it. The base kinds (email, ip, card, phone) are reported whenever they pass their
validator; the further kinds (iban, ssn) only with a score of at least ``threshold``.

Matches of a kind are leftmost and do not overlap; a match that fails is dropped without a
second try inside it. Only an iban is tried again: capitals and numbers around it look like
groups of it, so it may end at any blank, first where its country's length says, then from the
longest on, and after a failure the search goes on at the next group. Matches of different kinds may overlap. Positions are code points.

Nulls: a null text is empty: no spans, and masking leaves it null. Repeated rows give repeated
rows, an empty table an empty result. ``mask`` keeps all columns, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from adlake.llm.common import slices

BASE = ("email", "ip", "card", "phone")
EXTRA = ("iban", "ssn")
KINDS = BASE + EXTRA
THRESHOLD = 0.6
#: Characters before and after a span in which its context words are looked for.
CONTEXT_CHARS = 60

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
#: A digit run that a match has not used up can only be entered at its first digit, which the
#: look-behind states; possessive repeats then make every search linear.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
#: Lengths of account numbers by country, from the public registry.
IBAN_LENGTHS = {
    country: length
    for length, countries in {
        15: "NO",
        16: "BE",
        18: "DK FI FK FO GL NL SD",
        19: "MK SI",
        20: "AT BA EE KZ LT LU MN XK",
        21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA",
        23: "AE GI IL IQ OM SO TL",
        24: "AD CZ ES MD PK RO SA SE SK TN VG",
        25: "LY PT ST",
        26: "IS TR",
        27: "BI DJ FR GR IT MC MR SM",
        28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
        29: "BR EG PS QA UA",
        30: "JO KW MU YE",
        31: "MT SC",
        32: "LC",
        33: "RU",
    }.items()
    for country in countries.split()
}
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Span:
    kind: str
    start: int
    end: int
    score: float


def luhn(number: str) -> bool:
    """Whether the check digit of 12 to 19 digits fits."""
    digits = [int(c) for c in number if c not in " -"]
    if not 12 <= len(digits) <= 19:
        return False
    doubled = (sum(divmod(2 * d, 10)) for d in digits[-2::-2])
    return (sum(digits[-1::-2]) + sum(doubled)) % 10 == 0


def mod_97(account: str) -> bool:
    """Whether an account number in the international form has remainder 1."""
    plain = account.replace(" ", "")
    if not 15 <= len(plain) <= 34:
        return False
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def octets(address: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in address.split("."))


def dialled(number: str) -> bool:
    return 9 <= sum("0" <= c <= "9" for c in number) <= 15


def assigned(number: str) -> bool:
    area, group, serial = number.split("-")
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


def emails(text: str) -> Iterator[tuple[int, int]]:
    """A local part reaches back from its ``@`` to the last address or other character; going
    from one ``@`` to the next keeps the search linear."""
    used, at = 0, text.find("@")
    before = 0
    while at >= 0:
        run = text[max(used, before) : at]
        start = at - (len(run) - len(run.rstrip(LOCAL)))
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            used = found.end()
            yield start, used
        before = at + 1
        at = text.find("@", at + 1)


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """A match is at most 68 characters, so trying its ends keeps the search linear."""
    at = 0
    while found := IBAN.search(text, at):
        start, end = found.span()
        ends = [end, *(n for n in range(end - 1, start, -1) if text[n] == " ")]
        usual = IBAN_LENGTHS.get(text[start : start + 2])
        ends.sort(key=lambda n: n - start - text.count(" ", start, n) != usual)
        at = next((n for n in ends if mod_97(text[start:n])), start + 1)
        if at > start + 1:
            yield start, at


@dataclass(frozen=True)
class Kind:
    name: str
    needs: str  # a text without any of these characters has no match
    spans: Callable[[str], Iterator[tuple[int, int]]]
    valid: Callable[[str], bool]
    start: float
    confirmed: float
    words: frozenset[str]


def by_pattern(pattern: re.Pattern) -> Callable[[str], Iterator[tuple[int, int]]]:
    return lambda text: (m.span() for m in pattern.finditer(text))


RULES = (
    Kind("email", "@", emails, lambda s: True, 0.9, 0.0, frozenset({"mail", "email", "contact"})),
    Kind("ip", ".", by_pattern(IP), octets, 0.6, 0.0, frozenset({"ip", "address", "host"})),
    Kind("card", "", by_pattern(CARD), luhn, 0.3, 0.4, frozenset({"card", "visa", "credit"})),
    Kind("phone", "+", by_pattern(PHONE), dialled, 0.6, 0.0, frozenset({"phone", "tel", "call"})),
    Kind("iban", "", ibans, mod_97, 0.3, 0.6, frozenset({"iban", "account", "bank"})),
    Kind(
        "ssn", "-", by_pattern(SSN), assigned, 0.3, 0.0, frozenset({"ssn", "social", "security"})
    ),
)
CONTEXT_BONUS = 0.35


def find(text: str, threshold: float = THRESHOLD) -> list[Span]:
    """All spans of a text, by start and then kind as listed."""
    spans = []
    digits = re.search("[0-9]", text) is not None
    for rule in RULES:
        if rule.needs not in text or (rule.name != "email" and not digits):
            continue
        for start, end in rule.spans(text):
            if not rule.valid(text[start:end]):
                continue
            before, after = text[max(0, start - CONTEXT_CHARS) : start], text[end : end + CONTEXT_CHARS]
            nearby = WORD.findall(f"{before} {after}".lower())
            score = rule.start + rule.confirmed
            score += CONTEXT_BONUS * (not rule.words.isdisjoint(nearby))
            if rule.name in BASE or score >= threshold:
                spans.append(Span(rule.name, start, end, round(min(score, 1.0), 3)))
    return sorted(spans, key=lambda s: (s.start, KINDS.index(s.kind)))


def masked(text: str, threshold: float = THRESHOLD) -> str:
    """The text with each stretch of overlapping spans replaced by ``[KIND]``, the kind of its
    best span (the first listed among equals)."""
    out, at, spans = [], 0, find(text, threshold)
    while spans:
        best, end = spans[0], spans[0].end
        start, n = spans[0].start, 1
        while n < len(spans) and spans[n].start < end:
            end = max(end, spans[n].end)
            best = max(best, spans[n], key=lambda s: (s.score, -KINDS.index(s.kind)))
            n += 1
        out += [text[at:start], f"[{best.kind.upper()}]"]
        at, spans = end, spans[n:]
    return "".join(out) + text[at:]


def joined(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def detect(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, spans): an array of (kind, start, end, score) per row."""
    span = pa.struct(
        [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]
    )

    def run(batches):
        for batch in batches:
            for rows in slices(batch):
                found = [
                    [vars(s) for s in find(text or "", threshold)]
                    for text in rows.column(1).to_pylist()
                ]
                spans = pa.array(found, pa.list_(span))
                yield pa.RecordBatch.from_arrays([rows.column(0), spans], ["doc_id", "spans"])

    return docs.select("doc_id", docs["text"].cast("string").alias("text")).mapInArrow(
        run,
        "doc_id bigint, spans array<struct<kind: string, start: bigint, end: bigint, score: double>>",
    )


def summarize(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_<kind> of the base kinds, base_sha256, spans: the spans in digest form."""
    names = ["doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans"]

    def run(batches):
        for batch in batches:
            for rows in slices(batch):
                found = [find(text or "", threshold) for text in rows.column(1).to_pylist()]
                counts = [
                    pa.array([sum(s.kind == k for s in spans) for spans in found], pa.int64())
                    for k in BASE
                ]
                base = [joined([s for s in spans if s.kind in BASE]) for spans in found]
                shas = [hashlib.sha256(s.encode()).hexdigest() for s in base]
                lists = [pa.array(shas, pa.string()), pa.array(map(joined, found), pa.string())]
                yield pa.RecordBatch.from_arrays([rows.column(0), *counts, *lists], names)

    counts = ", ".join(f"n_{k} bigint" for k in BASE)
    return docs.select("doc_id", docs["text"].cast("string").alias("text")).mapInArrow(
        run, f"doc_id bigint, {counts}, base_sha256 string, spans string"
    )


def mask(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced and ``n_chars``, if there, recounted."""
    names = docs.columns

    def run(batches):
        for batch in batches:
            for rows in slices(batch):
                texts = [
                    None if text is None else masked(text, threshold)
                    for text in rows.column(names.index("text")).to_pylist()
                ]
                columns = list(rows.columns)
                columns[names.index("text")] = pa.array(texts, pa.string())
                if "n_chars" in names:
                    at = names.index("n_chars")
                    sizes = [None if text is None else len(text) for text in texts]
                    columns[at] = pa.array(sizes, pa.int64()).cast(columns[at].type)
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, docs.schema)
