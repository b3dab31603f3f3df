"""Personal data against the plain regular expressions."""

from __future__ import annotations

import hashlib
import random
import re
import time

from casemill.llm.pii import (
    base_spans,
    find_spans,
    luhn,
    mod_97,
    personal_data,
    redact,
    redacted,
    span_digests,
)
from tests.llm.helpers import awkward_rows, frame, with_clashing_columns

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text):
    spans = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card":
                total = 0
                for i, c in enumerate(reversed(digits)):
                    d = int(c) * (1 + i % 2)
                    total += d - 9 if d > 9 else d
                if not 12 <= len(digits) <= 19 or total % 10:
                    continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            spans.append((kind, m.start(), m.end()))
    return spans


def test_base_spans_are_those_of_the_patterns():
    rng = random.Random(4)
    bits = ["a", "x1", "@", ".", "-", " ", "+", "1", "42", "255", "4111 1111 1111 1111", "é",
            "a@b.co", "@@", "10.0.0.1", "+1 (499) 555-6503", "300.1.1.1", "00192.168.0.1"]
    for _ in range(4000):
        text = "".join(rng.choices(bits, k=rng.randint(1, 25)))
        assert base_spans(text) == brute(text), text


def test_checksums():
    assert luhn("4111111111111111") and not luhn("4111111111111112")
    assert mod_97("GB82WEST12345698765432") and not mod_97("GB82WEST12345698765433")


def test_context_adjusts_and_admits():
    assert [s[0] for s in find_spans("078-05-1120")] == []
    assert [s[0] for s in find_spans("his social security number 078-05-1120")] == ["ssn"]
    assert [s[0] for s in find_spans('token = "24be64439e3e49cf46b2d7c90f3602a3"')] == ["secret"]
    assert "iban" in [s[0] for s in find_spans("IBAN GB82 WEST 1234 5698 7654 32")]
    bare, near = find_spans("10.0.0.1")[0][3], find_spans("server 10.0.0.1")[0][3]
    assert near > bare


def test_query_rows(spark):
    rows = awkward_rows() + [(50, "mail a@b.co é 10.0.0.1 a@b.co", "en", "s", 28)] * 2
    out = span_digests(personal_data(with_clashing_columns(frame(spark, rows)))).collect()
    assert len(out) == len(rows)
    by_id = {r.doc_id: r for r in out}
    hit = by_id[50]
    assert (hit.n_email, hit.n_ip, hit.n_card, hit.n_phone) == (2, 1, 0, 0)
    text = "email:5:11,ip:14:22,email:23:29"
    assert hit.spans == text
    assert hit.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert by_id[4].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert by_id[4].spans == "" and by_id[4].n_email == 0
    assert span_digests(personal_data(frame(spark, []))).count() == 0


def test_redaction_keeps_rows_and_columns(spark):
    assert redact("call +1 (499) 555-6503 now") == "call [PHONE] now"
    assert redact(None) is None and redact("") == ""
    docs = frame(spark)
    out = redacted(docs)
    assert out.columns == docs.columns and out.count() == docs.count()


def test_account_numbers_before_and_after_other_capitals():
    accounts = [
        "ES9121000418450200051332", "ES91 2100 0418 4502 0005 1332", "AT611904300234573201",
        "PL61109010140000071219812874", "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32",
        "NO9386011117947", "MT84MALT011000012345MTLCAST001S",
    ]
    for account in accounts:
        for before in ("IBAN ", "konto: ", "account AB12 CDEF GHIJ ", "iban XX99 "):
            for after in ("", " BIC CAIXESBB", " BIC X", " A", " IBAN", ".", " and", " AB12 CDEF"):
                text = before + account + after
                spans = [s[1:3] for s in find_spans(text) if s[0] == "iban"]
                assert spans == [(len(before), len(before) + len(account))], text
                assert redact(text) == before + "[IBAN]" + after
    both = "IBAN " + " ".join(accounts)
    found = [both[s[1] : s[2]] for s in find_spans(both) if s[0] == "iban"]
    assert found == accounts
    # Part of a longer word is no end of an account.
    assert not [s for s in find_spans("IBAN AT611904300234573201x") if s[0] == "iban"]


def test_a_million_digits_take_one_pass():
    """Long runs of digits, also with dots that never make an address, and numbers of zeros."""
    for text in ("7" * 1_000_000, "1." * 300_000, "9" * 400_000 + ".1.2", "1.2." + "0" * 500_000 + ".4",
                 "+" + "1 " * 300_000, "a" * 500_000 + "@", "AB12" * 200_000):
        started = time.perf_counter()
        found = base_spans(text)
        find_spans(text)
        assert time.perf_counter() - started < 20
        assert not [s for s in found if s[0] == "ip"] or text.startswith(("1.2.", "1.1."))
    zeros = "1.2." + "0" * 5000 + ".4"
    assert base_spans(zeros)[0] == ("ip", 0, len(zeros))


def test_addresses_after_failed_starts():
    rng = random.Random(8)
    for _ in range(3000):
        text = "".join(rng.choices("0129.. ", k=rng.randint(0, 30)))
        want = [("ip", m.start(), m.end()) for m in re.finditer(PLAIN["ip"], text)
                if all(int(p) <= 255 for p in m.group().split("."))]
        assert [s for s in base_spans(text) if s[0] == "ip"] == want, text
