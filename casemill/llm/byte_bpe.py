"""Byte-level BPE: texts to token ids by merging rows of padded matrices, and back again.

A text is cut by the pattern; each distinct piece is a row of bytes. Rows of like length form a
matrix, padded at the end. In every round each row merges its leftmost pair of the least rank: one
argmin a row, a hashed lookup of the ranks of the two new neighbour pairs, and a compaction that
closes the gap and takes finished rows out. All rows of a matrix advance together.

Defined results: a null text is an empty one and has no ids; rows are treated one by one, so
repeated rows and null or repeated ids of documents pass through as they are, an empty table gives
an empty one, and other columns are ignored whatever their names. Equal ranks in a row go to the
leftmost pair. A piece longer than ``LONGEST_ROW`` bytes would need as many rounds as it has merges
over its whole row; such a piece is merged in the same order through a heap instead.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemill.llm.shared import ship

VOCABULARY = "byte_bpe_50k.tiktoken"
#: A pair that no token stands for.
NO_RANK = np.uint32(0xFFFFFFFF)
#: What fills a row up to its matrix's width; it forms no pair.
PAD = np.uint32(0xFFFFFFFE)
#: Longer pieces, in bytes, are merged through a heap.
LONGEST_ROW = 256
#: Cells of one matrix.
MATRIX_CELLS = 1 << 21
#: Texts are encoded in runs of whole documents of about so many characters.
RUN_CHARS = 1 << 21
#: A worker forgets the pieces it has met when it knows so many.
CACHE_PIECES = 400_000
#: Longer pieces, in characters, are not remembered.
LONGEST_CACHED = 64

_HASH = np.uint64(0x9E3779B97F4A7C15)


class PairRanks:
    """Rank of the token that two neighbouring tokens' bytes form, in an open hash table."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        lefts, rights, values = [], [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left = ranks.get(token[:cut])
                if left is None:
                    continue
                right = ranks.get(token[cut:])
                if right is not None:
                    lefts.append(left)
                    rights.append(right)
                    values.append(rank)
        keys = self._keys(np.array(lefts, np.uint32), np.array(rights, np.uint32))
        self.bits = max(8, int(np.ceil(np.log2(max(1, len(keys)) * 4))))
        self.keys = np.full(1 << self.bits, np.uint64(0xFFFFFFFFFFFFFFFF))
        self.values = np.full(1 << self.bits, NO_RANK)
        at, left = self._slots(keys), np.arange(len(keys))
        while len(left):
            free = self.keys[at] == np.uint64(0xFFFFFFFFFFFFFFFF)
            _, first = np.unique(at[free], return_index=True)  # one key a slot
            won = np.flatnonzero(free)[first]
            self.keys[at[won]] = keys[left[won]]
            self.values[at[won]] = np.array(values, np.uint32)[left[won]]
            rest = np.ones(len(left), bool)
            rest[won] = False
            left, at = left[rest], (at[rest] + 1) & (len(self.keys) - 1)

    @staticmethod
    def _keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.uint64) << np.uint64(32)) | right

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _HASH) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, NO_RANK where no token stands for it."""
        keys = self._keys(left, right)
        at = self._slots(keys)
        found = self.keys[at]
        out = np.where(found == keys, self.values[at], NO_RANK)
        # An entry of another key: look on until the key or a free slot.
        open_ = np.flatnonzero((found != keys) & (found != np.uint64(0xFFFFFFFFFFFFFFFF)))
        while len(open_):
            at[open_] = (at[open_] + 1) & (len(self.keys) - 1)
            slot = at[open_]
            found = self.keys[slot]
            hit = found == keys[open_]
            out[open_[hit]] = self.values[slot[hit]]
            open_ = open_[~hit & (found != np.uint64(0xFFFFFFFFFFFFFFFF))]
        return out


def _widths() -> list[int]:
    """Widths of the matrices: powers of two and their halfway marks up to LONGEST_ROW."""
    widths = [2, 3]
    while widths[-1] < LONGEST_ROW:
        widths += [widths[-2] * 2, widths[-1] * 2]
    return [w for w in widths if w <= LONGEST_ROW]


class ByteBpe:
    """Ids of texts and texts of ids by a vocabulary of ranked byte strings."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks = ranks
        self.pieces = regex.compile(pattern).findall
        self.pair_ranks = PairRanks(ranks)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.uint32)
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.decimals = [str(i) for i in range(len(tokens))]
        self.known: dict[str, bytes] = {}

    # --- encoding ---------------------------------------------------------------------------

    def merged_rows(self, rows: list[bytes]) -> list[np.ndarray]:
        """The ids of each row, all of at most LONGEST_ROW bytes; rows are merged side by side."""
        lengths = np.array([len(r) for r in rows], np.int64)
        out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(rows)
        widths = np.array(_widths())
        bucket = widths[np.searchsorted(widths, lengths)]
        for width in np.unique(bucket):
            members = np.flatnonzero(bucket == width)
            step = max(1, MATRIX_CELLS // int(width))
            for first in range(0, len(members), step):
                self._merge_matrix(rows, members[first : first + step], lengths, int(width), out)
        return out

    def _merge_matrix(self, rows, members, lengths, width, out) -> None:
        filled = b"".join(rows[i].ljust(width, b"\0") for i in members)
        ids = self.byte_ids[np.frombuffer(filled, np.uint8)].reshape(len(members), width)
        size = lengths[members]
        ids[np.arange(width) >= size[:, None]] = PAD
        ranks = self.pair_ranks(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(members), -1)
        while True:
            at = ranks.argmin(axis=1)  # the first of equal ones: leftmost
            best = ranks[np.arange(len(ranks)), at]
            live = best != NO_RANK
            if not live.all():
                for i in np.flatnonzero(~live):
                    out[members[i]] = ids[i, : size[i]].copy()
                if not live.any():
                    return
                ids, ranks, members = ids[live], ranks[live], members[live]
                size, at, best = size[live], at[live], best[live]
            n, wide = ids.shape
            line = np.arange(n)
            ids[line, at] = best
            stays = np.ones((n, wide), bool)
            stays[line, at + 1] = False
            ids = ids[stays].reshape(n, wide - 1)
            size = size - 1
            if wide == 2:
                for i in range(n):
                    out[members[i]] = ids[i, :1].copy()
                return
            stays = np.ones((n, wide - 1), bool)
            stays[line, at] = False
            ranks = ranks[stays].reshape(n, wide - 2)
            has = np.flatnonzero(at > 0)
            ranks[has, at[has] - 1] = self.pair_ranks(ids[has, at[has] - 1], ids[has, at[has]])
            has = np.flatnonzero(at < wide - 2)
            ranks[has, at[has]] = self.pair_ranks(ids[has, at[has]], ids[has, at[has] + 1])

    def merged_long(self, row: bytes) -> np.ndarray:
        """The ids of one row of any length, the same merges taken from a heap of pairs."""
        ids = self.byte_ids[np.frombuffer(row, np.uint8)]
        pairs = self.pair_ranks(ids[:-1], ids[1:])
        some = np.flatnonzero(pairs != NO_RANK)
        heap = list(zip(pairs[some].tolist(), some.tolist(), strict=True))
        heapq.heapify(heap)
        token = ids.tolist()
        n = len(token)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        size = [1] * n  # bytes of the token that starts here; 0: merged away
        place = self.ranks.get

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (rank := place(row[i : j + size[j]])) is not None:
                heapq.heappush(heap, (rank, i))

        while heap:
            rank, i = heapq.heappop(heap)
            if not size[i]:
                continue
            j = after[i]
            if j >= n or place(row[i : j + size[j]]) != rank:
                continue  # one of the two has been merged since
            token[i], size[i], size[j] = rank, size[i] + size[j], 0
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return np.array([token[i] for i in range(n) if size[i]], np.uint32)

    def learn(self, pieces: set[str]) -> dict[str, bytes]:
        """Little-endian unsigned 32-bit ids of pieces."""
        names, rows, out = [], [], {}
        for piece in pieces:
            row = piece.encode()
            whole = self.ranks.get(row)
            if whole is not None:
                out[piece] = whole.to_bytes(4, "little")
            elif len(row) > LONGEST_ROW:
                out[piece] = self.merged_long(row).astype("<u4").tobytes()
            else:
                names.append(piece)
                rows.append(row)
        for name, ids in zip(names, self.merged_rows(rows), strict=True):
            out[name] = ids.astype("<u4").tobytes()
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        cut = [self.pieces(text) if text else [] for text in texts]
        fresh = set().union(*cut).difference(self.known)
        if len(self.known) + len(fresh) > CACHE_PIECES:
            self.known.clear()
            fresh = set().union(*cut)
        self.known.update(self.learn(fresh))
        ids = [b"".join(map(self.known.__getitem__, pieces)) for pieces in cut]
        for piece in fresh:
            if len(piece) > LONGEST_CACHED:
                del self.known[piece]
        return ids

    # --- decoding ---------------------------------------------------------------------------

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of all ids in turn."""
        sizes = self.sizes[ids]
        firsts = np.cumsum(sizes) - sizes
        within = np.arange(int(sizes.sum())) + np.repeat(self.starts[ids] - firsts, sizes)
        return self.flat[within]

    def decimal(self, ids: np.ndarray) -> str:
        """Decimal ids joined by one space."""
        if len(ids) < 2:
            return "".join(map(str, ids.tolist()))
        return " ".join(itemgetter(*ids.tolist())(self.decimals))


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of byte strings from a file with a base64 string and a rank a line."""
    with open(path, "rb") as file:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in file if line.strip())}


@functools.lru_cache(maxsize=2)
def byte_bpe(vocabulary: str, pattern: str) -> ByteBpe:
    """The tokenizer of this worker process for a vocabulary file.

    ``vocabulary`` names a file of the public tokenizers, each host asking for its own path, or is
    a path that every host can open.
    """
    path = vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary)
    return ByteBpe(read_ranks(path), pattern)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str | None]]]:
    """doc_ids and texts of about RUN_CHARS characters at a time."""
    for batch in batches:
        first, waiting, texts = 0, 0, []
        for i, text in enumerate(batch.column(1)):
            texts.append(text.as_py())
            waiting += len(texts[-1] or "")
            if waiting >= RUN_CHARS or i + 1 == batch.num_rows:
                yield batch.column(0).slice(first, len(texts)), texts
                first, waiting, texts = i + 1, 0, []


def _inputs(docs: DataFrame, column: str) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col(column).cast("string").alias("text"))


def token_ids(
    docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = public_tokenizers.PATTERN
) -> DataFrame:
    """doc_id and token_ids (array of int) of every text of ``docs`` (doc_id, text)."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(vocabulary, pattern)
        for doc_ids, texts in _runs(batches):
            codes = bpe.encode(texts)
            ends = np.cumsum([0, *(len(c) // 4 for c in codes)]).astype(np.int32)
            ids = np.frombuffer(b"".join(codes), "<u4").astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))
            yield pa.RecordBatch.from_arrays([doc_ids, lists], ["doc_id", "token_ids"])

    return _inputs(docs, "text").mapInArrow(run, "doc_id long, token_ids array<int>")


def decoded_bytes(
    tokens: DataFrame, vocabulary: str = VOCABULARY, pattern: str = public_tokenizers.PATTERN
) -> DataFrame:
    """doc_id and decoded (binary) of every row of ``tokens`` (doc_id, token_ids).

    The bytes of any list of ids need not be whole characters, hence binary; a null list of ids is
    an empty one.
    """
    ship(tokens.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(vocabulary, pattern)
        for batch in batches:
            out = [
                bpe.decode(np.array(row.as_py() or [], np.int64)).tobytes()
                for row in batch.column(1)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out, pa.binary())], ["doc_id", "decoded"]
            )

    return tokens.select(
        F.col("doc_id").cast("long"), F.col("token_ids").cast("array<int>")
    ).mapInArrow(run, "doc_id long, decoded binary")


def token_digests(
    docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = public_tokenizers.PATTERN
) -> DataFrame:
    """Encode every text of ``docs`` (doc_id, text), decode its ids, and list digests of both.

    Returns doc_id, n_tokens, ids_sha256 (of the decimal ids joined by one space) and
    decoded_sha256 (of the decoded bytes). One pass over the texts: nothing is shuffled.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(vocabulary, pattern)
        for doc_ids, texts in _runs(batches):
            counts, id_digests, text_digests = [], [], []
            for code in bpe.encode(texts):
                ids = np.frombuffer(code, "<u4").astype(np.int64)
                counts.append(len(ids))
                id_digests.append(hashlib.sha256(bpe.decimal(ids).encode()).hexdigest())
                text_digests.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    doc_ids,
                    pa.array(counts, pa.int64()),
                    pa.array(id_digests, pa.string()),
                    pa.array(text_digests, pa.string()),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return _inputs(docs, "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
