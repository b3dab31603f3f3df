"""Fingerprints: edited texts, the order of documents, accuracy against exact similarity."""

from __future__ import annotations

import hashlib
import random
import re
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from casemill.llm.fingerprint import (
    BIN_BITS,
    BINS,
    LOWEST,
    WIDTH,
    _donors,
    _with_fingerprint,
    fingerprints,
    packed_text,
)
from tests.llm.helpers import awkward_rows, frame, row, with_clashing_columns, words
from tests.conftest import plan_of


def jaccard(a, b):
    def grams(t):
        w = t.lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    x, y = grams(a), grams(b)
    return len(x & y) / len(x | y) if x | y else 1.0


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))


def test_edited_texts_follow_the_next_document(spark):
    rows = [r for r in awkward_rows() if r[0] != 16] + [row(16, words(14, 80))]
    out = {r.doc_id: r for r in fingerprints(with_clashing_columns(frame(spark, rows))).collect()}
    assert len(out) == len(rows)
    line = ordered(rows)
    for r, after in zip(line, line[1:] + line[:1], strict=True):
        text, following = r[1] or "", after[1] or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        got = out[r[0]]
        assert got.n_chars == len(text)
        assert got.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert got.near_edited == pytest.approx(jaccard(text, edited), abs=0.2)
        assert got.near_next == pytest.approx(jaccard(text, following), abs=0.2)
        assert len(got.fingerprint) == (2 * BINS if text.split() else 0)


def test_a_bin_is_staged_as_one_byte(spark):
    rows = frame(spark, [row(1, words(1, 60)), row(2, "")]).select("doc_id", "text")
    made = _with_fingerprint(rows, F.col("text"), "own")
    assert made.schema["own"].dataType.simpleString() == "array<tinyint>"
    printed = {r.doc_id: r for r in made.select("doc_id", "own", packed_text(F.col("own")).alias("hex")).collect()}
    assert bytes.fromhex(printed[1].hex) == bytes(v + LOWEST for v in printed[1].own)
    assert len(printed[1].own) == BINS and printed[2].hex == ""


def test_equal_texts_have_equal_fingerprints(spark):
    rows = awkward_rows() + [row(50, words(14, 80))]
    out = fingerprints(frame(spark, rows)).collect()
    assert len(out) == len(rows)
    assert len({r.fingerprint for r in out if r.doc_id in (14, 16, 50)}) == 1


def test_estimates_are_unbiased(spark):
    rng = random.Random(4)
    rows = []
    for i in range(120):
        base = words(i, rng.choice([20, 60, 200, 600])).split()
        cut = rng.randint(0, len(base))
        rows.append(row(2 * i + 1, " ".join(base)))
        rows.append(row(2 * i, " ".join(base[:cut] + words(10_000 + i, len(base) - cut).split())))
    texts = {r[0]: r[1] for r in rows}
    out = {r.doc_id: r for r in fingerprints(frame(spark, rows).repartition(7)).collect()}
    errors = [out[2 * i + 1].near_next - jaccard(texts[2 * i + 1], texts[2 * i]) for i in range(120)]
    assert abs(sum(errors) / len(errors)) < 0.02
    assert max(map(abs, errors)) < 0.2


def test_single_and_no_documents(spark):
    one = fingerprints(frame(spark, [row(1, words(1, 30))])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert fingerprints(frame(spark, [])).count() == 0


def test_plan_has_no_python(spark):
    plan = plan_of(fingerprints(frame(spark)))
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_bins_and_donors_against_plain_python(spark):
    """Bins by the high bits, the smallest hash of each, donors in fixed order, then low bits."""

    def signed(x):
        return x - (1 << 64) if x >> 63 else x

    def chained(parts, seed=42):
        for part in parts:
            seed = xxhash.xxh64_intdigest(part, seed)
        return signed(seed)

    def plain(text):
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", text.lower()) if x]
        if not w:
            return ""
        runs = [w[i : i + WIDTH] for i in range(len(w) - WIDTH + 1)] if len(w) >= WIDTH else [w]
        held = {}
        for h in (chained([x.encode() for x in run]) for run in runs):
            place = (h >> (64 - BIN_BITS)) + BINS // 2
            held[place] = min(h, held.get(place, h))
        out = []
        for i in range(BINS):
            tried = [held[d] for d in _donors()[i] if d in held]
            nearest = min((chained([struct.pack("<i", b), struct.pack("<i", i)]), h) for b, h in held.items())
            out.append(held.get(i, tried[0] if tried else nearest[1]) & 255)
        return bytes(out).hex()

    rows = [r for r in awkward_rows() if r[0] not in (12, 16)] + [row(70, words(70, 900))]
    out = {r.doc_id: r.fingerprint for r in fingerprints(frame(spark, rows)).collect()}
    for doc_id, text, *_ in rows:
        assert out[doc_id] == plain(text or ""), doc_id
