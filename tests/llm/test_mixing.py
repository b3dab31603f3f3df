"""Mixing: targets, subset sums by brute force, and the mix as a whole."""

from __future__ import annotations

import itertools
import random
import re

import pytest

from casemill.llm.mixing import fit_counts, mix_sources, reshare
from tests.llm.helpers import awkward_rows, frame, row, with_clashing_columns, words


def test_targets_share_all_words_and_respect_the_caps():
    assert reshare([100, 100, 100], [1, 2, 3]) == pytest.approx([50, 100, 150])
    out = reshare([10, 1000, 10], [1, 2, 3])
    assert out[2] == 30 and sum(out) == pytest.approx(1020)
    assert reshare([], []) == []
    assert reshare([0, 6], [3, 1]) == pytest.approx([0, 6])


def best_gap(counts, budget):
    sums = {0}
    for n, c in counts.items():
        sums = {s + k * n for s in sums for k in range(c + 1)}
    return min(abs(s - budget) for s in sums)


def test_fit_counts_is_as_near_as_any_subset():
    rng = random.Random(1)
    for _ in range(200):
        counts = {rng.randint(0, 40): rng.randint(1, 4) for _ in range(rng.randint(1, 6))}
        total = sum(n * c for n, c in counts.items())
        budget = rng.randint(0, total + 5)
        got = fit_counts(counts, budget)
        assert all(0 < k <= counts[n] for n, k in got.items())
        gap = abs(sum(n * k for n, k in got.items()) - min(budget, total))
        longest = max(counts)
        assert gap <= max(best_gap(counts, min(budget, total)), longest // 2)
    exact = {n: 50 for n in range(3, 60)}
    assert sum(n * k for n, k in fit_counts(exact, 12_345).items()) == 12_345


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def check_mix(out, rows):
    order = sorted({r[3] for r in rows}, key=lambda s: (s is None, s or ""))
    sizes = [sum(size(r[1]) for r in rows if r[3] == s) for s in order]
    targets = dict(zip(order, reshare(sizes, [1 + i % 3 for i in range(len(order))]), strict=True))
    assert len(out) == len(rows)
    taken = dict.fromkeys(order, 0)
    for r in out:
        assert r.source_size == sizes[order.index(r.source)]
        assert r.target == pytest.approx(targets[r.source])
        assert r.taken == r.passes * r.size and 0 <= r.passes <= 3
        taken[r.source] += r.taken
    for s, total in zip(order, sizes, strict=True):
        longest = max([size(r[1]) for r in rows if r[3] == s])
        assert abs(taken[s] - targets[s]) <= max(1, longest / 2), (s, total)


def test_mix(spark):
    rows = awkward_rows()
    docs = with_clashing_columns(frame(spark, rows))
    check_mix(mix_sources(docs).collect(), rows)
    assert mix_sources(frame(spark, [])).count() == 0


def test_mix_with_a_hot_source_and_reruns(spark):
    rng = random.Random(2)
    rows = [
        row(i, words(i, rng.randint(0, 30)), source="hot" if i % 3 else f"s{i % 7}")
        for i in range(600)
    ]
    docs = frame(spark, rows)
    first = mix_sources(docs).collect()
    check_mix(first, rows)
    again = mix_sources(docs.repartition(5, "text")).collect()
    assert sorted((r.doc_id, r.taken) for r in first) == sorted((r.doc_id, r.taken) for r in again)
    other = mix_sources(docs, seed=21).collect()
    assert sorted((r.doc_id, r.taken) for r in first) != sorted((r.doc_id, r.taken) for r in other)
    by_source = {}
    for r in first:
        by_source.setdefault(r.source, [0, r.target])[0] += r.taken
    assert all(abs(taken - target) <= 1 for taken, target in by_source.values())


def test_sizes_of_copies(spark):
    rows = [row(i, t) for i, t in enumerate(itertools.repeat("same text here", 40))]
    check_mix(mix_sources(frame(spark, rows)).collect(), rows)
