"""Token files (round trip against the library) and packing (validity and closeness to the bound)."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from casemill.llm.packing import best_fit, local_search, pack_sequences
from casemill.llm.token_store import TokenShard, pack_shard, token_files, write_token_files
from casemill.llm.tokens import END_ID, chunk_ids, vocabulary_path
from tests.llm.helpers import awkward_rows, frame, row, with_clashing_columns, words


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary_path())


def plain_ids(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids + [END_ID]
    return np.array(ids, "<u4").tobytes()


def test_chunks_give_the_ids_of_whole_texts(library):
    chunks = chunk_ids(vocabulary_path())
    end = np.array([END_ID], "<u4").tobytes()
    extra = ["a b　c\x85d", "X,;. Y!?", "l'été: ÇA, ÿ. µ!", "\x1c \x1f", "ab.'s 's", "é, İ."]
    for text in [r[1] for r in awkward_rows()] + extra:
        assert chunks.text(text) + end == plain_ids(library, text)


def test_shard_round_trip_and_random_access():
    rng = np.random.default_rng(3)
    texts = []
    for n in (1, 5, 4000, 1, 20000):
        ids = np.append(rng.choice([7, 8, 9, 70000], n, p=[0.4, 0.3, 0.2, 0.1]), END_ID)
        texts.append(ids.astype("<u4").tobytes())
    payload = pack_shard([5, None, 7, 8, 9], texts)
    shard = TokenShard(payload)
    assert shard.doc_ids == [5, None, 7, 8, 9]
    assert len(shard.rules) > 0 and len(payload) < sum(map(len, texts)) / 3
    assert shard.all_ids().astype("<u4").tobytes() == b"".join(texts)
    for i, text in enumerate(texts):
        ids = np.frombuffer(text, "<u4")
        assert (shard.document(i) == ids).all()
        for start, stop in ((0, 1), (3, 9), (len(ids) - 2, len(ids) + 5), (len(ids), None)):
            assert (shard.document(i, start, stop) == ids[start:stop]).all()
    lengths = shard.lengths[shard.seq]
    assert lengths.sum() == len(shard.all_ids())


def test_shard_leaves_no_frequent_pair():
    from collections import Counter

    rng = np.random.default_rng(8)
    passage = np.arange(5000, 5300)
    texts = []
    for k in range(60):
        body = [rng.integers(10, 1500, 2000), passage, np.full(90, 4), [7, 8]]
        texts.append(np.concatenate([[3], *body, [END_ID]]).astype("<u4").tobytes())
    shard = TokenShard(pack_shard(list(range(60)), texts))
    for i, text in enumerate(texts):
        ids = np.frombuffer(text, "<u4")
        assert (shard.document(i) == ids).all()
        assert (shard.document(i, 1990, 2100) == ids[1990:2100]).all()
    # Pairs that don't overlap, from left to right, within documents.
    seen, free = Counter(), {}
    for i in range(60):
        seq = shard.seq[shard.symbols[i] : shard.symbols[i + 1]].tolist()
        free.clear()
        for at, pair in enumerate(zip(seq, seq[1:], strict=False)):
            if free.get(pair, 0) <= at:
                seen[pair] += 1
                free[pair] = at + 2
    assert max(seen.values()) < 24
    # The passage is a few symbols of many ids, not one per id or per sixteen.
    assert shard.lengths.max() >= 200


def test_token_files(spark, library):
    rows = awkward_rows()
    out = token_files(with_clashing_columns(frame(spark, rows))).collect()
    expected = sorted(
        (r[0] if r[0] is not None else -1, plain_ids(library, r[1])) for r in rows
    )
    got = sorted((r.start, r.doc_id if r.doc_id is not None else -1, r.n_tokens, r.ids_crc32) for r in out)
    at = 0
    assert len(got) == len(expected)
    for (start, doc_id, n, crc), (want_id, ids) in zip(got, expected, strict=True):
        assert (start, doc_id, n, crc) == (at, want_id, len(ids) // 4, zlib.crc32(ids))
        at += n


def test_token_files_empty(spark):
    assert token_files(frame(spark, [])).count() == 0
    assert write_token_files(frame(spark, [])).count() == 0


def check_packing(out, rows, library, capacity):
    import collections

    ids = collections.defaultdict(list)
    for r in rows:
        ids[r[0]].append(plain_ids(library, r[1]))
    sequences = collections.defaultdict(list)
    pieces = collections.defaultdict(list)
    for r in out:
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    for doc_id, copies in ids.items():
        want = sorted(
            (k, s, min(capacity, len(b) // 4 - s), zlib.crc32(b[4 * s : 4 * (s + capacity)]))
            for b in copies
            for k, s in enumerate(range(0, len(b) // 4, capacity))
        )
        assert sorted(pieces[doc_id]) == want
    return len(sequences)


def test_packing(spark, library):
    rows = awkward_rows()
    docs = with_clashing_columns(frame(spark, rows))
    check_packing(pack_sequences(docs).collect(), rows, library, 4096)
    out = pack_sequences(docs, capacity=64).collect()
    made = check_packing(out, rows, library, 64)
    total = sum(len(plain_ids(library, r[1])) // 4 for r in rows)
    assert made <= -(-total // 64) + 1
    assert pack_sequences(frame(spark, [])).count() == 0


def test_packing_over_several_lots(spark, library, monkeypatch):
    monkeypatch.setattr("casemill.llm.packing.LOT_PIECES", 40)
    rows = [row(i, words(i, 3 + i % 50)) for i in range(200)]
    out = pack_sequences(frame(spark, rows), capacity=256).collect()
    made = check_packing(out, rows, library, 256)
    total = sum(len(plain_ids(library, r[1])) // 4 for r in rows)
    assert made <= 1.1 * total / 256 + 1


def test_local_search_empties_a_bin():
    # One-for-one: 6 with 5 fills the first bin, and the third's piece then fits.
    lengths = np.array([5, 4, 6, 3, 1, 1])
    bins = [[0, 1], [2, 3], [4], [5]]
    out = local_search(bins, lengths, 10)
    assert sorted(i for b in out for i in b) == list(range(6))
    assert len(out) == 2
    # Two-for-one: 3 + 3 against 5 leaves a full bin.
    lengths = np.array([5, 4, 3, 3])
    out = local_search([[0, 1], [2, 3]], lengths, 10)
    assert max(sum(lengths[b]) for b in out) == 10


def test_best_fit_takes_the_tightest_room():
    lengths = np.array([6, 5, 4, 5, 4, 6])
    assert len(best_fit(lengths, 10)) == 3
    assert best_fit(np.array([], int), 10) == []


def test_local_search_leaves_no_change_in_any_bin():
    rng = np.random.default_rng(1)
    for lengths, capacity in (
        (rng.integers(1200, 1701, 400), 4096),
        (np.concatenate([rng.integers(2, 5, 900), rng.integers(250, 420, 150)]), 1000),
    ):
        first = [b.tolist() for b in np.array_split(np.arange(len(lengths)), len(lengths) // 2)]
        if capacity == 4096:
            first = best_fit(lengths, capacity)
        out = local_search(first, lengths, capacity)
        assert sorted(i for b in out for i in b) == list(range(len(lengths)))
        fill = [int(lengths[b].sum()) for b in out]
        assert max(fill) <= capacity and len(out) < len(first)
        sizes = [sorted(set(lengths[b].tolist())) for b in out]
        gives = []
        for b in out:
            own = lengths[b].tolist()
            pairs = {x + y for k, x in enumerate(own) for y in own[k + 1 :]} if len(own) < 99 else set()
            gives.append(sorted(set(own) | pairs))
        for p, a in enumerate(fill):
            for o, b in enumerate(fill):
                if p == o:
                    continue
                for out_sum in gives[p]:
                    for back in [0, *sizes[o]]:
                        shift = out_sum - back
                        if 0 < shift <= capacity - b:
                            assert b - a + shift <= 0, (p, o, out_sum, back)
