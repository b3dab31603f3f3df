"""Vector codes against full rounds in plain Python integers."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from casemill.llm.vector_codes import (
    LARGEST,
    assign,
    coded_vectors,
    compress_vectors,
    decoded_vectors,
    distances,
    fit_codes,
)

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=8, entries=16, rounds=6):
    def sound(v):
        return v and all(c is not None and math.isfinite(c) for c in v)

    kept = [(i, [float(np.float32(c)) for c in v], label) for i, v, label in rows if sound(v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    if not kept:
        return []
    wide = -(-len(kept[0][1]) // parts)
    x = []
    for _, v, _ in kept:
        whole = [max(-LARGEST, min(LARGEST, math.floor(4096 * c))) for c in v]
        whole += [0] * (parts * wide - len(whole))
        x.append([whole[p * wide : (p + 1) * wide] for p in range(parts)])
    books = [[v[p] for v in x[:entries]] for p in range(parts)]

    def far(a, b):
        return sum((i - j) ** 2 for i, j in zip(a, b, strict=True))

    def nearest(p, v):
        return min((far(v, e), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        codes = [[nearest(p, v[p])[1] for p in range(parts)] for v in x]
        for p in range(parts):
            for k in range(len(books[p])):
                mine = [v[p] for v, c in zip(x, codes, strict=True) if c[p] == k]
                if mine:
                    books[p][k] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    out, labels = [], {}
    digest = hashlib.sha256(
        ",".join(str(c) for b in books for e in b for c in e).encode()
    ).hexdigest()
    for (i, _, label), v in zip(kept, x, strict=True):
        best = [nearest(p, v[p]) for p in range(parts)]
        error = sum(d for d, _ in best)
        labels[label] = labels.get(label, 0) + error
        out.append((i, "".join(f"{k:02x}" for _, k in best), error, label))
    return sorted(((i, c, e, labels[w], digest) for i, c, e, w in out), key=str)


def listed(df):
    names = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted((tuple(r) for r in df.select(*names).collect()), key=str)


def vectors(seed, n, width):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(5)]
    rows = []
    for i in range(n):
        v = [c + rng.gauss(0, 0.3) for c in rng.choice(centres)]
        rows.append((i * 3 + 1, v, rng.choice([0, 0, 0, 1, 2, None])))
    return rows


def test_codes_equal_full_rounds(spark, monkeypatch):
    monkeypatch.setattr("casemill.llm.vector_codes.BLOCK", 50)
    rows = vectors(1, 400, 16)
    rows += [(r[0], list(r[1]), 7) for r in rows[:40]] + [(5000 + i, rows[0][1], 0) for i in range(90)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert listed(compress_vectors(df)) == brute(rows)


def test_awkward_vectors(spark):
    v = [0.5, -0.25, 1e-9, -1e-9, 3.0, 7.0, -7.0, 0.0, 1.0]
    rows = [
        (3, v, None), (1, v[:4], 0), (2, [*v[:8], None], 0), (4, None, 0), (5, [], 1),
        (6, [*v[:8], float("nan")], 0), (7, [float("inf"), *v[:8]], 0), (None, v, 2),
        (3, [-c for c in v], 0), (9, [1e30, -1e30, *v[2:]], 0), (0, v[::-1], None),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    names = ["marked", "absent", "ids", "codes", "parts", "sums", "label_error"]
    clashing = df.select("*", *[F.lit(n).alias(n) for n in names])
    assert listed(compress_vectors(clashing)) == brute(rows)
    assert listed(compress_vectors(df.filter("vec_id = 4"))) == []
    assert listed(compress_vectors(df.limit(0))) == []


@pytest.mark.parametrize("scale", [3, 1 << 25])
def test_active_entries_equal_a_full_scan(scale):
    """Ties included: stored distances and moved entries give what all entries give."""
    rng = np.random.default_rng(scale)
    x = rng.integers(-3, 4, (500, 2)).astype(np.int32) * (scale // 3)
    entries = rng.integers(-3, 4, (16, 2)).astype(np.int64) * (scale // 3)
    code, far = assign(x, entries, np.ones(16, bool), np.zeros(500, int), np.zeros(500, np.int64))
    for step in range(8):
        moved = rng.random(16) < (0.0, 0.2, 0.6, 1.0)[step % 4]
        entries = np.where(moved[:, None], rng.integers(-3, 4, (16, 2)) * (scale // 3), entries)
        code, far = assign(x, entries, moved, code, far)
        full = distances(x, entries)
        exact = ((x[:, None].astype(object) - entries[None].astype(object)) ** 2).sum(2)
        assert (full == exact).all()
        assert (code == full.argmin(1)).all() and (far == full.min(1)).all()


def test_decoded_vectors_have_the_stated_error(spark):
    rows = vectors(2, 120, 10)
    df = spark.createDataFrame(rows, SCHEMA)
    fitted = fit_codes(df)
    coded = coded_vectors(fitted, spark)
    near = {r.vec_id: r.embedding for r in decoded_vectors(coded, fitted.books, 10).collect()}
    errors = {r.vec_id: r.error for r in coded.collect()}
    for i, v, _ in rows:
        whole = [math.floor(4096 * float(np.float32(c))) for c in v]
        assert sum((a - round(b * 4096)) ** 2 for a, b in zip(whole, near[i], strict=True)) == errors[i]
