"""Embedding links against all pairs in double precision."""

from __future__ import annotations

import math

import numpy as np
import pytest

from casemill.llm.embedding_dedup import Graph, embedding_duplicates, linked_points

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold=0.93):
    def sound(v):
        return (
            v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v) and any(v)
        )

    n = len(rows)
    links, parent = [0] * n, list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    unit = [
        np.array(v, np.float32).astype(float) / np.linalg.norm(np.array(v, np.float32).astype(float))
        if sound(v) else None
        for _, v, _ in rows
    ]
    for i in range(n):
        for j in range(i):
            if rows[i][0] is None or rows[j][0] is None or rows[i][2] is None:
                continue
            if rows[i][2] != rows[j][2] or unit[i] is None or unit[j] is None:
                continue
            if len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold:
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    least = {}
    for i in range(n):
        if rows[i][0] is not None:
            least[root(i)] = min(least.get(root(i), rows[i][0]), rows[i][0])
    out = []
    for i in range(n):
        c = None if rows[i][0] is None else least[root(i)]
        out.append((rows[i][0], links[i], c, rows[i][0] == c))
    return sorted(out, key=str)


def result(df):
    return sorted(
        ((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect()), key=str
    )


def clustered(seed, n, width=16, labels=2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, width))
    rows = []
    for i in range(n):
        v = rng.normal(size=width)
        if rng.random() < 0.6:
            v = centres[rng.integers(6)] + rng.normal(size=width) * rng.choice([0.05, 0.2])
        rows.append((int(i), [float(x) for x in v.astype(np.float32)], int(rng.integers(labels))))
    return rows


def test_links_and_components(spark, monkeypatch):
    monkeypatch.setattr("casemill.llm.embedding_dedup.SHARD_POINTS", 150)
    rows = clustered(1, 500)
    rows += [(1000 + i, rows[3][1], rows[3][2]) for i in range(40)]
    rows += [(i, rows[i + 7][1], rows[i][2]) for i in range(20)]  # a vec_id with another vector
    out = result(embedding_duplicates(spark.createDataFrame(rows, SCHEMA)))
    want = brute(rows)
    assert sum(r[1] for r in out) >= 0.99 * sum(r[1] for r in want)
    assert sum(a != b for a, b in zip(out, want, strict=True)) <= 5


def test_repeated_ids_keep_every_vector(spark):
    """The second vector of vec_id 1 is the one that vec_id 3 links with."""
    rows = [(1, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (3, [0.05, 1.0], 0), (1, [0.0, 1.0], 1)]
    out = result(embedding_duplicates(spark.createDataFrame(rows, SCHEMA)))
    assert out == brute(rows)
    assert (3, 1, 1, False) in out


def test_links_count_for_both_ends(spark, monkeypatch):
    """Counts add up: over all rows, what one end counts the other counts as well."""
    monkeypatch.setattr("casemill.llm.embedding_dedup.SHARD_POINTS", 60)
    monkeypatch.setattr("casemill.llm.embedding_dedup.BEAMS", (2,))
    rows = clustered(5, 400, labels=1)
    out = embedding_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    found = {r.vec_id: r.n_links for r in out}
    want = {r[0]: r[1] for r in brute(rows)}
    assert all(found[k] <= want[k] for k in want)
    assert sum(found.values()) % 2 == 0


def test_awkward_vectors(spark):
    v = [1.0, 2.0, 3.0]
    rows = [
        (1, v, 0), (2, v, 0), (2, v, 0), (3, v, None), (4, None, 0), (5, [], 0),
        (6, [0.0, 0.0, 0.0], 0), (7, [1.0, None, 3.0], 0), (8, [1.0, float("nan"), 3.0], 0),
        (9, [1.0, float("inf"), 0.0], 0), (None, v, 0), (10, [2.0, 4.0, 6.0], 0),
        (11, [1.0, 2.0, 3.0, 0.0], 0), (12, v, 1), (13, [-1.0, -2.0, -3.0], 0),
    ]
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, SCHEMA).withColumn("point", F.lit("x"))
    assert result(embedding_duplicates(df)) == brute(rows)
    assert embedding_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_graph_search_recall(seed):
    """At least 0.9 of all links by beams alone, on data without a scan."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(1500, 24))
    x = np.concatenate([x, x[:700] + rng.normal(size=(700, 24)) * 0.1])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph = Graph(x, np.arange(len(x))).build(rng.permutation(len(x)))
    ids, _ = graph.search(x.astype(np.float32), 32)
    true = [set(np.flatnonzero(r >= 0.93)) for r in x @ x.T]
    caught = sum(len(t & set(i)) for t, i in zip(true, ids, strict=True))
    assert caught >= 0.98 * sum(map(len, true))
    found = linked_points(graph, x, x, 0.93, 32)
    assert sum(map(len, found)) >= 0.98 * sum(map(len, true))
    assert all(set(f) <= t for f, t in zip(found, true, strict=True))
