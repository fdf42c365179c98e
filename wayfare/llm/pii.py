"""Personal data: regular expressions propose spans, checksums confirm them, words nearby move the score.

Base kinds are e-mail, IP address, card number and phone number; bank accounts
(IBAN) and social security numbers are added by the method. Places are code
points of the whole text, end exclusive.

Results in odd cases: a null or empty text has no spans; very long runs of one
sort of character cost time in proportion to their length only; repeated rows
give repeated results; extra columns are not looked at (``find``) or kept
(``mask``). In ``mask`` overlapping spans are replaced as one, named after the
first of them.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from hashlib import sha256

from pyspark.sql import DataFrame

from wayfare.llm.common import arrow_map, table

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn")

# The patterns of the given task. The e-mail pattern is
# [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+ and is matched from each "@" outwards.
EMAIL_BEFORE = re.compile(r"[A-Za-z0-9._%+-]+")
EMAIL_AFTER = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# The method's own kinds. An account is proposed at every place it can begin, as long as it can be.
IBAN = re.compile(
    r"(?<![A-Za-z0-9])(?=([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?)(?![A-Za-z0-9]))")
#: Characters of an account by country, blanks aside.
IBAN_LENGTHS = {country: length for length, countries in {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}.items() for country in countries.split()}
SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")

# Words whose nearness raises a kind's score, and words that lower it.
CONTEXT = {
    "email": ("mail", "email", "e-mail", "contact", "write"), "ip": ("ip", "address", "host", "server", "login"),
    "card": ("card", "visa", "mastercard", "credit", "payment", "cvv"),
    "phone": ("phone", "call", "tel", "mobile", "fax"), "iban": ("iban", "bank", "account", "transfer"),
    "ssn": ("ssn", "social", "security", "taxpayer"),
}
AGAINST = {"ip": ("version", "release", "section"), "card": ("order", "isbn", "tracking"), "ssn": ("part", "serial", "model")}
START = {"email": 0.9, "ip": 0.7, "card": 0.9, "phone": 0.7, "iban": 0.95, "ssn": 0.5}
STEP = 0.2
NEAR = 40
LEAST = 0.6


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def mod97(code: str) -> bool:
    compact = code.replace(" ", "")
    return 15 <= len(compact) <= 34 and int("".join(str(int(c, 36)) for c in compact[4:] + compact[:4])) % 97 == 1


def accounts(text: str) -> list[tuple[int, int]]:
    """Spans that mod 97 confirms, not overlapping: first those of their country's length, leftmost first; then others, as
    proposed or, where the country is not listed, the longest that ends at a blank (a word after an account may look like
    a part of it)."""
    sure, others = [], []
    for found in IBAN.finditer(text):
        start, end = found.span(1)
        ends = [end, *(e for e in range(end - 1, start, -1) if text[e] == " ")]
        length = IBAN_LENGTHS.get(text[start:start + 2])
        exact = [e for e in ends if e - start - text.count(" ", start, e) == length]
        if exact and mod97(text[start:exact[0]]):
            if not sure or start >= sure[-1][1]:
                sure.append((start, exact[0]))
        else:
            others += [(start, e) for e in (ends[:1] if length else ends) if mod97(text[start:e])][:1]
    kept, done = list(sure), 0
    for start, end in others:
        at = bisect_left(sure, (start,))
        if start >= max(done, sure[at - 1][1] if at else 0) and (at == len(sure) or end <= sure[at][0]):
            kept.append((start, end))
            done = end
    return sorted(kept)


def emails(text: str):
    """Leftmost matches, not overlapping: the run of name characters before an "@" and the domain after it."""
    done, at = 0, text.find("@")
    while at >= 0:
        domain = EMAIL_AFTER.match(text, at)
        if domain:
            start = at
            while start > done and EMAIL_BEFORE.match(text[start - 1]):
                start -= 1
            if start < at:
                done = domain.end()
                yield start, done
        at = text.find("@", max(at + 1, done))


def proposals(text: str):
    """(kind, start, end) of what patterns propose and checks confirm."""
    if "@" in text:
        for start, end in emails(text):
            yield "email", start, end
    for found in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in found[0].split(".")):
            yield "ip", *found.span()
    for found in CARD.finditer(text):
        if found.end() - found.start() >= 13:
            digits = found[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield "card", *found.span()
    if "+" in text:
        for found in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in found[0]) <= 15:
                yield "phone", *found.span()
    for start, end in accounts(text):
        yield "iban", start, end
    for found in SSN.finditer(text):
        yield "ssn", *found.span()


def score(text: str, kind: str, start: int, end: int) -> float:
    """Confidence from 0 to 1: the kind's own, moved by context words within ``NEAR`` characters."""
    near = set(re.findall(r"[a-z-]+", text[max(0, start - NEAR):end + NEAR].lower()))
    value = START[kind] + STEP * bool(near & set(CONTEXT[kind])) - STEP * bool(near & set(AGAINST.get(kind, ())))
    return min(1.0, max(0.0, round(value, 3)))


def spans(text: str | None) -> list[tuple[str, int, int, float]]:
    """All spans by kind as listed, then start; base kinds stay whatever their score."""
    if not text:
        return []
    found = [(k, s, e, score(text, k, s, e)) for k, s, e in proposals(text)]
    found = [f for f in found if f[0] in BASE_KINDS or f[3] >= LEAST]
    return sorted(found, key=lambda f: (KINDS.index(f[0]), f[1]))


def written(found) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end, *_ in found)


def find(docs: DataFrame) -> DataFrame:
    """Spans, scores and counts per document."""

    def run(ids, texts):
        each = [spans(t) for t in texts]
        counts = [Counter(f[0] for f in found) for found in each]
        return {
            "doc_id": ids, **{f"n_{k}": [c[k] for c in counts] for k in KINDS},
            "base_sha256": [
                sha256(written(f for f in found if f[0] in BASE_KINDS).encode()).hexdigest() for found in each],
            "spans": [written(found) for found in each], "scores": [[f[3] for f in found] for found in each],
        }

    schema = {"doc_id": "long", **{f"n_{k}": "long" for k in KINDS}, "base_sha256": "string", "spans": "string",
              "scores": "array<double>"}
    return arrow_map(docs.select("doc_id", "text"), run, schema)


def hide(text: str | None) -> str | None:
    """The text with each stretch of personal data replaced by its kind in brackets."""
    if not text:
        return text
    out, done = [], 0
    for kind, start, end, _ in sorted(spans(text), key=lambda f: (f[1], -f[2])):
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def mask(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data replaced in text, and n_chars to match; other columns as they are."""
    names = docs.columns

    def run(batches):
        import pyarrow as pa

        from wayfare.llm.common import slices

        for part in slices(batches):
            hidden = [hide(t) for t in part.column(names.index("text")).to_pylist()]
            columns = list(part.columns)
            columns[names.index("text")] = pa.array(hidden, part.schema.field("text").type)
            if "n_chars" in names:
                sizes = [None if t is None else len(t) for t in hidden]
                columns[names.index("n_chars")] = pa.array(sizes, part.schema.field("n_chars").type)
            yield pa.RecordBatch.from_arrays(columns, schema=part.schema)

    return docs.mapInArrow(run, docs.schema)


def op10_pii(spark, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents")).select(
        "doc_id", *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans")
