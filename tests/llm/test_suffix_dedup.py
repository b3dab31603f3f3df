"""Repeated byte strings against brute force over all windows."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from casemill.llm.suffix_dedup import equal_windows, remove_repeats
from tests.llm.helpers import awkward_rows, frame, row, with_clashing_columns, words


def brute(rows):
    least = {}
    for doc_id, text, *_ in rows:
        raw = (text or "").encode()
        if doc_id is not None:
            for i in range(len(raw) - 49):
                w = raw[i : i + 50]
                least[w] = min(least.get(w, doc_id), doc_id)
    out = []
    for doc_id, text, *_ in rows:
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        if doc_id is not None:
            for i in range(len(raw) - 49):
                if least[raw[i : i + 50]] < doc_id:
                    gone[i : i + 50] = True
        left = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(raw) else 0
        out.append((doc_id, len(raw), int(gone.sum()), runs, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


def result(spark, rows):
    out = remove_repeats(with_clashing_columns(frame(spark, rows))).drop("kept_text")
    return sorted((tuple(r) for r in out.collect()), key=str)


@pytest.mark.parametrize("seed", range(6))
def test_two_stage_order_is_that_of_plain_sorting(seed):
    rng = random.Random(seed)
    letters = "ab" if seed % 2 else "abcdeé日"
    base = "".join(rng.choices(letters, k=400)) + "zyxwvutsr" * 9 + "a" * 120
    raw = base.encode()
    contexts, owned = [], []
    for _ in range(40):
        n = rng.randint(1, 25)
        at = rng.randrange(len(raw) - n - 49)
        contexts.append(raw[at : at + n + 49])
        owned.append(n)
    contexts = list(dict(zip(contexts, owned, strict=True)))
    owned = np.array([len(c) - 49 for c in contexts])
    order, same = equal_windows(contexts, owned)
    joined = b"\xff".join(contexts) + b"\xff"
    windows = [joined[i : i + 50] for i in order]
    assert len(windows) == owned.sum() and windows == sorted(windows)
    assert same.tolist() == [False] + [a == b for a, b in zip(windows, windows[1:])]


def test_awkward_rows(spark):
    rows = awkward_rows()
    assert result(spark, rows) == brute(rows)


def test_shared_passages_copies_and_periodic_texts(spark):
    rng = random.Random(3)
    passages = [words(500 + i, n) for i, n in enumerate((9, 12, 30, 80, 200))]
    rows = []
    for i in range(160):
        parts = []
        for _ in range(rng.randint(0, 5)):
            parts.append(rng.choice([words(rng.randrange(10**6), rng.randint(1, 30)), rng.choice(passages)]))
        rows.append(row(rng.choice([i, i + 1000]), rng.choice([" ", "\n", " - "]).join(parts)))
    rows += [row(3000 + i, "Und " * rng.randint(5, 60)) for i in range(6)]
    rows += [row(4000 + i, "é" * rng.randint(20, 70) + passages[2][i : 90 + i]) for i in range(9)]
    rows += [row(5000 - i, passages[4]) for i in range(5)]
    rows += [row(6000 - i, "x" * n) for i, n in enumerate((49, 50, 51, 200))]
    assert result(spark, rows) == brute(rows)


def test_several_shards_and_batches(spark, monkeypatch):
    monkeypatch.setattr("casemill.llm.suffix_dedup.SHARD_BYTES", 4_000)
    rng = random.Random(5)
    passages = [words(700 + i, 40) for i in range(10)]
    rows = [
        row(i, " ".join([words(i, rng.randint(5, 60)), rng.choice(passages), words(-i, 7)]))
        for i in range(150)
    ]
    assert result(spark, rows) == brute(rows)


def test_rows_that_repeat_a_doc_id_with_other_texts(spark):
    passages = [words(700 + i, 20) for i in range(3)]
    rows = [row(1, " ".join(passages))]
    for doc_id in (5, 6):
        rows += [
            row(doc_id, passages[0] + " " + words(710 + doc_id, 60)),
            row(doc_id, words(720 + doc_id, 50) + " " + passages[1] + words(730 + doc_id, 9)),
            row(doc_id, words(740 + doc_id, 90)),
        ]
    rows += [rows[-1], row(7, words(750, 30) + passages[2])]
    assert result(spark, rows) == brute(rows)


def test_empty(spark):
    assert remove_repeats(frame(spark, [])).count() == 0
    rows = [row(1, None), row(2, "")]
    assert result(spark, rows) == brute(rows)


def test_a_text_in_parts_has_the_same_anchors(monkeypatch):
    """Every window keeps its anchor; only runs may be cut."""
    from casemill.llm import suffix_dedup

    data = np.frombuffer((words(3, 300) + words(4, 40) * 5).encode(), np.uint8)
    bounds = np.array([0, len(data)])

    def windows():
        hashes, owner, first, n = suffix_dedup.anchors(data, bounds)
        assert (owner == 0).all()
        return [(f + i, h) for h, f, m in zip(hashes, first, n, strict=True) for i in range(m)]

    whole = windows()
    assert len(whole) == len(data) - suffix_dedup.WINDOW + 1
    for part in (50, 51, 97, 1000):
        monkeypatch.setattr(suffix_dedup, "LONGEST_PART", part)
        assert windows() == whole
