"""The trie of rebuilt conversations against a plain one in dictionaries."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from casemill.llm.prefix_trie import (
    TernaryTree,
    _Run,
    conversation_trie,
    encode_turns,
    prefix_trie,
    rebuilt,
)
from casemill.session import staged

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            own.setdefault(c, []).append((turn is not None, turn or 0, key, role, text))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    nodes = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        seq = tuple(own.get(c - c % 20, [])[:h] + turns[h:])
        for d in range(len(seq) + 1):
            nodes.setdefault(seq[:d], ([], []))[0].append(c)
        nodes[seq][1].append(c)
    kids = {}
    for p in nodes:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    leaves, saved, out = {}, {}, []
    for p in sorted(nodes, key=len, reverse=True):
        below = kids.get(p, [])
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        leaves[p] = sum(leaves[q] for q in below) or 1
        saved[p] = sum(saved[q] for q in below) + (len(nodes[p][0]) - 1) * words
        members, ends = nodes[p]
        parent = min(nodes[p[:-1]][0]) if p else None
        digest = hashlib.sha256(",".join(map(str, sorted(ends))).encode()).hexdigest()
        out.append((min(members), len(p), parent, len(members), len(below), leaves[p], saved[p], digest))
    return sorted(out, key=str)


def listed(nodes):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
             "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in nodes.select(*names).collect()), key=str)


def conversations(seed, n):
    rng = random.Random(seed)
    texts = ["", "one", "two words", "größe  x\ty", "z" * 3000, "日本 語 "]
    rows = []
    for c in range(n):
        for turn in range(rng.choice([0, 1, 2, 3, 5, 8])):
            text = rng.choice(texts) if turn < 3 else f"{rng.randrange(4)} tail"
            rows.append((c, turn, rng.choice(["user", "assistant"]) if turn % 2 else "user", text))
    return rows


AWKWARD = [
    (1, 0, None, None), (1, None, "user", "first"), (1, 0, "user", "tie"), (1, 0, "user", "tie"),
    (1, 0, "assistant", "tie"), (None, 0, "user", "nobody"), (40, 0, "user", "head"),
    (40, 5, "user", "head 2"), (41, 0, "x", "own"), (50, 0, "x", "own"), (57, 0, "x", "own"),
    (-3, 0, "user", "negative"), (7, 0, "", ""), (8, 0, None, None),
]


@pytest.mark.parametrize("turns", [1_000_000, 60])
def test_nodes_equal_a_plain_trie(spark, turns):
    """In one shard and in many: boundary nodes are merged to the same rows."""
    rows = conversations(1, 150) + [(900 + i, t, "user", "copy") for i in range(60) for t in range(3)]
    df = spark.createDataFrame(rows, SCHEMA)
    made = prefix_trie(rebuilt(staged(encode_turns(df), "coded")), turns)
    assert listed(made) == brute(rows)


def test_awkward_rows_and_clashing_columns(spark):
    df = spark.createDataFrame(AWKWARD, SCHEMA)
    names = ["ids", "words", "turn_id", "turn_key", "head_id", "kind", "ends", "node_key"]
    clashing = df.select("*", *[F.lit(n).alias(n) for n in names])
    rows = [r for r in AWKWARD if r[0] is None or r[0] >= 0]
    assert listed(conversation_trie(clashing.filter("conv_id IS NULL OR conv_id >= 0"))) == brute(rows)
    assert conversation_trie(df).filter("depth = 0").count() == 1
    assert conversation_trie(df.limit(0)).count() == 0


def test_a_long_conversation_and_its_copy(spark):
    """Thousands of turns in many shards: sums by doubling, no recursion."""
    long = [(c, t, "user", f"{t % 7} w") for c in (20, 21) for t in range(1500)]
    rows = long + [(22, t, "user", f"{t % 7} w") for t in range(700)] + conversations(3, 10)
    df = spark.createDataFrame(rows, SCHEMA)
    made = prefix_trie(rebuilt(staged(encode_turns(df), "coded")), 1_000)
    assert listed(made) == brute(rows)


def test_members_of_a_node_are_streamed_in_pieces(spark, monkeypatch):
    monkeypatch.setattr("casemill.llm.prefix_trie.PIECE_IDS", 7)
    rows = [(c, 0, "user", "same") for c in range(0, 2000, 20)]
    made = conversation_trie(spark.createDataFrame(rows, SCHEMA))
    assert listed(made) == brute(rows)


def test_median_insertion_is_balanced():
    import numpy as np

    runs = [_Run(np.array([i, 5]), np.array([1, 2])) for i in range(1023)]
    tree = TernaryTree()
    tree.insert_by_medians(runs)

    def height(at):
        deepest, waiting = 0, [(at, 1)]
        while waiting:
            node, level = waiting.pop()
            if node >= 0:
                deepest = max(deepest, level)
                waiting += [(tree.low[node], level + 1), (tree.high[node], level + 1)]
        return deepest

    assert height(tree.equal[0]) == 10
    order = tree.ordered()
    assert [tree.key[n] for n in order[1::2]] == list(range(1023)) and len(order) == 2047
