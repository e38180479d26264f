"""Personal data: patterns propose spans, checksums confirm them, words nearby move their score.

Kinds with a fixed definition (email, ip, card, phone) are reported whenever pattern and validator agree; the
further kinds (iban, ssn, secret) are reported when their score, moved by context words, reaches `MIN_SCORE`.

Cases: a null or empty text has no spans; repeated rows give repeated results; an empty table an empty result;
offsets are code points, ends exclusive; texts are searched whole. Other columns pass through `redact` untouched.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import ROW, by_text_bytes, id_and_text, map_texts, packed, released

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn", "secret")
MIN_SCORE = 0.5
CONTEXT_CHARS = 40

# The base patterns. An address is found from its @ on; the run before it is its local part.
_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# From the start of a run of digits on: a match further in would have matched there too.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}")
_IBAN_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
_ALNUM = _IBAN_CHARS | frozenset("abcdefghijklmnopqrstuvwxyz")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_SECRET = re.compile(
    r"(?i)(?<![a-z0-9])(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)[\"']?[\x20]?[=:][\x20]?[\"']?"
    r"(?P<value>[^\s,;\"']{6,})|(?P<key>(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9]))"
)
_DIGITS = str.maketrans("", "", "".join(chr(c) for c in range(128) if not chr(c).isdigit()))

# Characters of an account number by country; other beginnings are no account numbers.
_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
IBAN_LENGTHS = {code: length for length, codes in _LENGTHS.items() for code in codes.split()}

# Words that make a kind likelier or less likely when they stand near a span.
CONTEXT = {
    "email": (("mail", "email", "contact", "write"), ("example",)),
    "ip": (("ip", "host", "server", "address", "login"), ("version", "release", "section", "v")),
    "card": (("card", "visa", "mastercard", "credit", "payment", "cvv"), ("order", "serial", "isbn", "tracking")),
    "phone": (("phone", "tel", "call", "mobile", "fax", "contact"), ("fax",)),
    "iban": (("iban", "bank", "account", "transfer", "konto", "bic"), ()),
    "ssn": (("ssn", "social", "security", "insurance"), ("order", "part", "serial", "isbn")),
    "secret": (("password", "secret", "token", "key", "login", "credential"), ("example", "placeholder")),
}
START = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "ssn": 0.4, "secret": 0.7}
_WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Span:
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def mod97(value: str) -> bool:
    """The check of an international bank account number."""
    compact = value.replace(" ", "")
    turned = compact[4:] + compact[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    floor = 0
    for m in _AT.finditer(text):
        start = m.start()
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            yield start, m.end()
            floor = m.end()


def _iban_end(text: str, start: int) -> int | None:
    """Where the account number that starts here ends: at its country's length, before a border, if mod-97 holds."""
    length, at, n = IBAN_LENGTHS.get(text[start : start + 2], 0), start, 0
    while n < length:
        at += n > 3 and text[at : at + 1] == " "
        if text[at : at + 1] not in _IBAN_CHARS:
            return None
        at, n = at + 1, n + 1
    return at if length and text[at : at + 1] not in _ALNUM and mod97(text[start:at]) else None


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    m = _IBAN.search(text)
    while m:
        end = _iban_end(text, m.start())
        if end:
            yield m.start(), end
        m = _IBAN.search(text, end or m.end())


def _matching(kind: str, text: str) -> Iterator[tuple[int, int]]:
    if kind == "email":
        yield from _emails(text) if "@" in text else ()
    elif kind == "ip":
        for m in _IP.finditer(text):
            if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255 for part in m[0].split(".")):
                yield m.span()
    elif kind == "card":
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = m[0].translate(_DIGITS)
                if 14 <= len(digits) <= 19 and luhn(digits):
                    yield m.span()
    elif kind == "phone":
        for m in _PHONE.finditer(text) if "+" in text else ():
            if 10 <= len(m[0].translate(_DIGITS)) <= 15:
                yield m.span()
    elif kind == "iban":
        yield from _ibans(text)
    elif kind == "ssn":
        for m in _SSN.finditer(text):
            if m[0][:3] not in ("000", "666") and m[0][0] != "9" and m[0][4:6] != "00" and m[0][7:] != "0000":
                yield m.span()
    else:
        for m in _SECRET.finditer(text):
            if m["key"]:
                yield m.span("key")
            elif _RANDOM.search(m["value"]):
                yield m.span("value")


_HAS_DIGIT = re.compile("[0-9]")
# A secret is no plain word: it has a digit, or letters of both cases beyond a capital at its start.
_RANDOM = re.compile(r"[0-9]|[a-z].*[A-Z]|[A-Z]{2}.*[a-z]", re.S)
_SECRET_WORD = re.compile("(?i)pass|pwd|secret|token|key|AKIA|ASIA")


def scored(kind: str, start: int, end: int, text: str) -> float:
    """The kind's starting score, moved by the words within reach of the span."""
    near = text[max(0, start - CONTEXT_CHARS) : start] + " " + text[end : end + CONTEXT_CHARS]
    words = set(_WORD.findall(near.lower()))
    more, less = CONTEXT[kind]
    score = START[kind] + 0.2 * bool(words & set(more)) - 0.3 * bool(words & set(less))
    return round(min(1.0, max(0.0, score)), 2)


def find_spans(text: str, kinds: tuple[str, ...] = KINDS) -> list[Span]:
    """All spans of one text by start, then kind as listed."""
    digits, secrets = _HAS_DIGIT.search(text) is not None, None
    found = []
    for rank, kind in enumerate(kinds):
        if kind == "secret":
            secrets = _SECRET_WORD.search(text) is not None
            if not secrets:
                continue
        elif kind != "email" and not digits:
            continue
        for start, end in _matching(kind, text):
            score = scored(kind, start, end, text)
            if kind in BASE_KINDS or score >= MIN_SCORE:
                found.append((start, rank, Span(kind, start, end, score)))
    found.sort(key=lambda x: x[:2])
    return [x[2] for x in found]


def spans_of(frame: DataFrame, id_col: str = "doc_id", text_col: str = "text", kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """(id, spans array<struct<kind, start, end, score>>) for every row."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in by_text_bytes(batches, "text"):
            spans = [
                [{"kind": s.kind, "start": s.start, "end": s.end, "score": s.score} for s in find_spans(t, kinds)]
                for t in batch["text"]
            ]
            yield pd.DataFrame({"id": batch["id"], "spans": spans})

    source = id_and_text(frame, id_col, text_col)
    return map_texts(source, work, "spans array<struct<kind:string,start:int,end:int,score:double>>")


def redacted(text: str, kinds: tuple[str, ...] = KINDS) -> str:
    """The text with each span, or union of overlapping spans, replaced by the name of its first kind in brackets."""
    out, done = [], 0
    merged: list[list] = []
    for s in find_spans(text, kinds):
        if merged and s.start < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], s.end)
        else:
            merged.append([s.start, s.end, s.kind])
    for start, end, kind in merged:
        out += [text[done:start], f"[{kind.upper()}]"]
        done = end
    return "".join([*out, text[done:]])


def redact(frame: DataFrame, text_col: str = "text", kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """The frame with personal data in its text column replaced; null texts stay null."""

    def work(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(lambda t: None if t is None else redacted(t, kinds))

    @F.pandas_udf("string")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        return released(work)(batches)

    rows = packed(frame).withColumn("__clean", clean(F.col(ROW)[text_col].cast("string")))
    return rows.select(
        *[F.col("__clean").alias(c) if c == text_col else F.col(ROW)[c].alias(c) for c in frame.columns]
    )
