"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score.

Base kinds are email, ip, card (Luhn) and phone. The method adds iban (mod 97) and, where a
context word stands near, ssn (three-two-four digits) and secret (a long token after an equals
sign or colon). A span's score starts from its kind and rises with a context word within
``CONTEXT`` characters before it; additional kinds below ``LEAST_SCORE`` are left out, base spans
always stay.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemill.llm.shared import ship

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn", "secret")
CONTEXT = 48
LEAST_SCORE = 0.6

# The patterns of the kinds.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
# A match can only begin where digits begin: were there one from a later digit of the same run,
# there would be one from the first. So a long run of digits is looked at once.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=(?:\x20?[A-Z0-9]{4}){2})")
_IBAN_GROUP = re.compile(r"\x20?[A-Z0-9]{4}")
_IBAN_TAIL = re.compile(r"\x20?[A-Z0-9]{1,3}(?![A-Za-z0-9])")
_IBAN_END = re.compile(r"(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_SECRET = re.compile(r"[=:][\x20]?[\"']?([A-Za-z0-9+/_-]{20,})")
_LOCAL_CLASS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

# Score a confirmed span starts from, and words that raise it.
START_SCORE = {
    "email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.7, "iban": 0.8, "ssn": 0.4, "secret": 0.4,
}
CONTEXT_WORDS = {
    "email": ("mail", "contact", "correo", "courriel"),
    "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "credit", "tarjeta", "karte", "carte"),
    "phone": ("phone", "call", "tel", "mobile", "fax"),
    "iban": ("iban", "bank", "account", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social", "security"),
    "secret": ("token", "secret", "key", "password", "passwd", "api"),
}
CONTEXT_GAIN = 0.2
#: Registered lengths of account numbers by country.
IBAN_LENGTHS = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI",
        20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
        24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
        27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
        29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}
_CONTEXT = {
    kind: re.compile(r"(?<![a-z])(?:%s)" % "|".join(words)) for kind, words in CONTEXT_WORDS.items()
}
_ORDER = {kind: i for i, kind in enumerate(KINDS)}


def luhn(digits: str) -> bool:
    """Whether the last digit is the Luhn checksum of the others."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = ord(c) - 48
        if i % 2:
            value = value * 2 - 9 if value > 4 else value * 2
        total += value
    return total % 10 == 0


def mod_97(account: str) -> bool:
    """Whether an account number in the international form has the remainder 1 by 97."""
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _at_most_255(digits: str) -> bool:
    value = digits.lstrip("0")
    return len(value) <= 3 and int(value or "0") <= 255


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: each has one @, so they are looked for from there to the left."""
    done = 0
    at = text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        if domain:
            start = at
            while start > done and text[start - 1] in _LOCAL_CLASS:
                start -= 1
            if start < at:
                done = domain.end()
                yield start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Confirmed spans of the base kinds, by kind and then by start."""
    spans = [("email", s, e) for s, e in _emails(text)]
    if not any(c in text for c in "0123456789"):
        return spans
    for m in _IP.finditer(text):
        if all(_at_most_255(p) for p in m.group().split(".")):
            spans.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = _digits(m.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                spans.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m.group())) <= 15:
                spans.append(("phone", m.start(), m.end()))
    return spans


def _iban_ends(text: str, start: int) -> list[int]:
    """Where an account number from ``start`` may end: after its groups, not within a word."""
    at, ends = start + 4, []
    for group in range(1, 8):
        m = _IBAN_GROUP.match(text, at)
        if not m:
            break
        at = m.end()
        if group > 1:
            tail = _IBAN_TAIL.match(text, at)
            ends += [at] if _IBAN_END.match(text, at) else []
            ends += [tail.end()] if tail else []
    return ends


def _ibans(text: str) -> list[tuple[int, int]]:
    """Account numbers that mod 97 confirms, from left to right.

    Those of their country's length come first. At other starts, all ends are tried if the country
    has no registered length, the last one first, and otherwise the last one only.
    """
    exact, others = [], []
    done = 0
    for m in _IBAN.finditer(text):
        start = m.start()
        if start < done:
            continue
        length = IBAN_LENGTHS.get(text[start : start + 2])
        ends = _iban_ends(text, start)
        for end in ends:
            account = text[start:end].replace(" ", "")
            if len(account) == length and mod_97(account):
                exact.append((start, end))
                done = end
                break
        else:
            others.append((start, ends[-1:] if length else ends[::-1]))
    spans = list(exact)
    begins = [*(s for s, _ in exact), len(text)]
    done = 0
    for start, ends in others:
        until = begins[bisect(begins, start)]
        for end in ends:
            account = text[start:end].replace(" ", "")
            if done <= start and end <= until and 15 <= len(account) <= 34 and mod_97(account):
                spans.append((start, end))
                done = end
                break
    return sorted(spans)


def added_spans(text: str) -> list[tuple[str, int, int]]:
    """Confirmed spans of the additional kinds."""
    spans = [("iban", s, e) for s, e in _ibans(text)]
    if "-" in text:
        spans += [("ssn", m.start(), m.end()) for m in _SSN.finditer(text)]
    if "=" in text or ":" in text:
        for m in _SECRET.finditer(text):
            token = m.group(1)
            if any(c.isdigit() for c in token) and any(c.isalpha() for c in token):
                spans.append(("secret", m.start(1), m.end(1)))
    return spans


def score(kind: str, start: int, text: str) -> float:
    near = text[max(0, start - CONTEXT) : start].lower()
    return START_SCORE[kind] + (CONTEXT_GAIN if _CONTEXT[kind].search(near) else 0.0)


def find_spans(text: str | None) -> list[tuple[str, int, int, float]]:
    """All spans (kind, start, end, score) of a text, by start and then by kind."""
    if not text:
        return []
    found = [(k, s, e, score(k, s, text)) for k, s, e in base_spans(text)]
    for k, s, e in added_spans(text):
        rated = score(k, s, text)
        if rated >= LEAST_SCORE:
            found.append((k, s, e, rated))
    found.sort(key=lambda x: (x[1], _ORDER[x[0]], x[2]))
    return found


SPAN_TYPE = "array<struct<kind:string,start:long,end:long,score:double>>"


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id and the spans (kind, start, end in code points, score) of each row's whole text.

    A null or empty text has no spans. Rows aren't moved: each row, also one that repeats a doc_id
    or has none, gives a row. Spans that start together stand in the order of ``KINDS``. A text of
    any length is searched whole, in time that grows with its length. An empty table gives an
    empty result; other columns are ignored, whatever their names.
    """
    ship(docs.sparkSession)
    return _per_text(docs, lambda text: find_spans(text), pa_spans(), f"doc_id long, spans {SPAN_TYPE}")


def redact(text: str | None) -> str | None:
    """The text with each span replaced by its kind in brackets; overlapping spans are one."""
    if not text:
        return text
    out, done = [], 0
    spans = find_spans(text)
    i = 0
    while i < len(spans):
        kind, start, end, _ = spans[i]
        i += 1
        while i < len(spans) and spans[i][1] < end:
            end = max(end, spans[i][2])
            i += 1
        out += [text[done:start], f"[{kind.upper()}]"]
        done = end
    return "".join([*out, text[done:]])


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with its texts redacted and n_chars, if there, counted again; no row is dropped.

    A null text stays null, an empty table empty; all other columns are carried along.
    """
    ship(docs.sparkSession)
    names = docs.columns
    at = names.index("text")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([redact(t.as_py()) for t in batch.column(at)], batch.column(at).type)
            columns = [texts if i == at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    out = docs.mapInArrow(clean, docs.schema)
    if "n_chars" in names:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.length("text").cast(kind))
    return out


def pa_spans() -> pa.DataType:
    return pa.list_(
        pa.struct(
            [
                ("kind", pa.string()),
                ("start", pa.int64()),
                ("end", pa.int64()),
                ("score", pa.float64()),
            ]
        )
    )


def _per_text(docs: DataFrame, function, kind: pa.DataType, schema: str) -> DataFrame:
    names = ["kind", "start", "end", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                [dict(zip(names, span, strict=True)) for span in function(t.as_py())]
                for t in batch.column(1)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, kind)], ["doc_id", "spans"]
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, schema)


def span_digests(spans: DataFrame) -> DataFrame:
    """Counts of the base kinds, the digest of the base spans, and all spans as a string."""

    def joined(column):
        return F.array_join(
            F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(kind).alias(f"n_{kind}") for kind in BASE_KINDS]
    return spans.select(
        "doc_id",
        *counts,
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        F.coalesce(
            F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0)
        ).alias("top_score"),
    )


def digest(text: str) -> str:
    """What ``base_sha256`` holds for a text, computed in Python."""
    base = [f"{k}:{s}:{e}" for k, s, e, _ in find_spans(text) if k in BASE_KINDS]
    return hashlib.sha256(",".join(base).encode()).hexdigest()
