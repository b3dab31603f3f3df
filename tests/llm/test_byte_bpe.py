"""Byte-level BPE against the tiktoken library, and exact round trips."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from casemill.llm import byte_bpe as bb
from tests.llm.helpers import awkward_rows, frame, with_clashing_columns


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "own",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=bb.read_ranks(public_tokenizers.path(bb.VOCABULARY)),
        special_tokens={},
    )


@pytest.fixture(scope="module")
def own():
    return bb.byte_bpe(bb.VOCABULARY, public_tokenizers.PATTERN)


LETTERS = [*"abcdefghijklmnopqrstuvwxyzABC 0123 \n\t'’.,;!?ñéßüИжшо中文字  \x1c\x85​🙂́²½ǅʰ",
           "'s", "ing", "the", " \n", "<|endoftext|>"]


def ids_of(own, text):
    return np.frombuffer(own.encode([text])[0], "<u4").tolist()


def test_ids_equal_the_library_on_random_texts(own, library):
    rng = random.Random(3)
    for k in range(2500):
        if k % 6:
            text = "".join(rng.choices(LETTERS, k=rng.randint(0, 80)))
        else:
            points = (rng.randrange(0x110000) for _ in range(30))
            text = "".join(chr(p) for p in points if not 0xD800 <= p < 0xE000)
        ids = ids_of(own, text)
        assert ids == library.encode_ordinary(text), text
        assert own.decode(np.array(ids, np.int64)).tobytes() == text.encode()


def test_rows_around_the_matrix_limit(own, library):
    rng = random.Random(5)
    for size in (1, 2, 3, 4, 5, 255, 256, 257, 300, 900):
        for letters in ("ab", "etaoinshr", "aé中"):
            text = "".join(rng.choices(letters, k=size))
            assert ids_of(own, text) == library.encode_ordinary(text)
            if text.isascii():
                assert own.merged_long(text.encode()).tolist() == library.encode_ordinary(text)


def test_leftmost_least_rank_with_few_tokens():
    """A vocabulary made for ties: 'aa' repeats, and 'ab' ranks before it."""
    ranks = {bytes([b]): b + 10 for b in range(256)}
    ranks |= {b"aa": 3, b"ab": 2, b"aab": 400, b"aaaa": 401}
    own = bb.ByteBpe(ranks, r"\S+|\s+")
    for text, pieces in {
        "aaa": ["aa", "a"], "aaaa": ["aaaa"], "aaab": ["aa", "ab"], "aab": ["aab"], "abab": ["ab", "ab"],
        "aaaaa": ["aaaa", "a"], "": [],
    }.items():
        assert ids_of(own, text) == [ranks[p.encode()] for p in pieces], text


def test_whole_and_very_long_texts(spark, library):
    rng = random.Random(9)
    long = " ".join("".join(rng.choices("etaoinshrdlu", k=rng.randint(1, 9))) for _ in range(150_000))
    rows = awkward_rows() + [(70, long, "en", "s", None), (71, "x" * 200_000, "en", "s", None)]
    df = with_clashing_columns(frame(spark, rows)).withColumn("token_ids", F.lit(1))
    out = bb.token_digests(df).collect()
    want = []
    for doc_id, text, *_ in rows:
        ids = library.encode_ordinary(text or "")
        want.append(
            (doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
             hashlib.sha256((text or "").encode()).hexdigest())
        )
    assert sorted(map(tuple, out), key=str) == sorted(want, key=str)
    assert bb.token_digests(frame(spark, []).limit(0)).count() == 0


def test_ids_and_texts_as_tables(spark, library):
    df = frame(spark)
    tokens = bb.token_ids(df)
    want = sorted(((r[0], library.encode_ordinary(r[1] or "")) for r in awkward_rows()), key=str)
    assert sorted(((r.doc_id, r.token_ids) for r in tokens.collect()), key=str) == want
    back = sorted(((r.doc_id, bytes(r.decoded)) for r in bb.decoded_bytes(tokens).collect()), key=str)
    assert back == sorted(((r[0], (r[1] or "").encode()) for r in awkward_rows()), key=str)


def test_a_small_cache_changes_nothing(own, library, monkeypatch):
    monkeypatch.setattr(bb, "CACHE_PIECES", 20)
    fresh = bb.ByteBpe(own.ranks, public_tokenizers.PATTERN)
    for _, text, *_ in awkward_rows():
        if text:
            assert ids_of(fresh, text) == library.encode_ordinary(text)
            assert len(fresh.known) <= max(20, len(set(fresh.pieces(text))))
