"""The n-gram join against all pairs compared by brute force."""

from __future__ import annotations

import random

import pytest

from casemill.llm.components import components
from casemill.llm.near_join import choose_depth, near_duplicates, recall_at
from tests.llm.helpers import awkward_rows, frame, row, with_clashing_columns, words


def shingles(text):
    lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
    w = [x for x in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in lowered).split(" ") if x]
    return tuple(w), {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    texts, sets = {}, {}
    for doc_id, text, *_ in rows:
        w, s = shingles(text)
        if w and doc_id is not None:
            texts.setdefault(w, doc_id)
            texts[w] = min(texts[w], doc_id)
            sets[w] = s
    keys = list(texts)
    parent = {k: k for k in keys}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    links = dict.fromkeys(keys, 0)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            both = len(sets[a] & sets[b])
            if 5 * both >= 4 * (len(sets[a]) + len(sets[b]) - both):
                links[a] += 1
                links[b] += 1
                parent[root(a)] = root(b)
    least = {}
    for k in keys:
        least[root(k)] = min(least.get(root(k), texts[k]), texts[k])
    out = []
    for doc_id, text, *_ in rows:
        w, _s = shingles(text)
        if not w or doc_id is None:
            out.append((doc_id, doc_id, doc_id, 0, True))
        else:
            c = least[root(w)]
            out.append((doc_id, c, texts[w], links[w], c == doc_id))
    return out


def as_rows(df):
    names = ["doc_id", "class_id", "text_id", "n_links", "kept"]
    return sorted((tuple(r) for r in df.select(names).collect()), key=str)


def corpus(n_groups=12, copies=25):
    rng = random.Random(8)
    rows, at = [], 100
    for g in range(n_groups):
        base = words(1000 + g, rng.choice([6, 40, 120, 400])).split()
        for _ in range(rng.randint(1, copies)):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 30))):
                w[rng.randrange(len(w))] = words(rng.randrange(10**6), 1)
            rows.append(row(at, " ".join(w)))
            at += 1
    rng.shuffle(rows)
    return rows


def test_awkward_rows(spark):
    rows = [r for r in awkward_rows()]
    out = near_duplicates(with_clashing_columns(frame(spark, rows)))
    assert as_rows(out) == sorted(brute(rows), key=str)


def test_groups_of_near_copies(spark):
    rows = corpus()
    assert as_rows(near_duplicates(frame(spark, rows))) == sorted(brute(rows), key=str)


def test_blocks_and_large_buckets(spark, monkeypatch):
    monkeypatch.setattr("casemill.llm.near_join.BLOCK_TEXTS", 7)
    monkeypatch.setattr("casemill.llm.near_join.BUCKET_ROWS", 5)
    monkeypatch.setattr("casemill.llm.near_join.UNIT_TEXTS", 3)
    rows = corpus(6, 40)
    assert as_rows(near_duplicates(frame(spark, rows))) == sorted(brute(rows), key=str)


def test_nothing_to_join(spark):
    assert near_duplicates(frame(spark, [])).count() == 0
    rows = [row(1, None), row(2, ""), row(3, words(3, 30))]
    assert as_rows(near_duplicates(frame(spark, rows))) == sorted(brute(rows), key=str)


def test_the_prefix_is_shortened_until_the_recall_is_met():
    assert recall_at(4, 0.8) > recall_at(5, 0.8)
    assert choose_depth({}, 0.8, 0.99) == 5
    assert choose_depth({}, 0.8, 0.9999) == 4
    assert choose_depth({5: 90, 3: 10}, 0.8, 0.99) == 3
    assert choose_depth({0: 10}, 0.8, 0.99) == 1


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(i, i + 1) for i in range(60)] + [(1000 + rng.randrange(80), 1000 + rng.randrange(80)) for _ in range(50)]
    edges += [(5000, 5000 + i) for i in range(1, 300)]
    rng.shuffle(edges)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    assert got == {x: root(x) for x in parent if any(x in e and e[0] != e[1] for e in edges)}


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
