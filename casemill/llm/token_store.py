"""Token files with grammar compression (Re-Pair) and random access.

A shard holds the ids of successive documents. Frequent pairs of neighbouring symbols are
replaced by new symbols, round after round; a rule says which two symbols a new one stands for,
and the length of its expansion is kept with it. Documents end with ``END_ID`` and no pair begins
with it, so every document starts at a symbol of its own and any range of its ids can be had by
skipping whole symbols by their expansion lengths.

All pairs of a round are counted over the whole shard and the most frequent ones are replaced
together: where two of them overlap, the more frequent one wins, and the other may win in the next
round. Rounds end when no pair occurs ``LEAST_COUNT`` times without overlapping itself.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casemill.llm.shared import ship
from casemill.llm.tokens import END_ID, chunk_ids, vocabulary_path
from casemill.session import staged

MAGIC = b"RPGS"
#: Chunks a worker remembers: writing files is a job by itself, so it may have more memory.
REMEMBERED_CHUNKS = 1_000_000
SHARD_IDS = 1 << 21
#: The most frequent pairs are replaced first; what is left is counted again in the next round.
RULES_A_ROUND = 4096
#: A pair must occur so often in the shard to be worth a rule.
LEAST_COUNT = 24
#: Rank of a place without a frequent pair.
NONE = np.int32(2**31 - 1)

SHARD_SCHEMA = (
    "part int, shard int, first_id long, last_id long, n_docs long, part_start long, "
    "n_tokens long, n_symbols long, payload binary"
)
DOCUMENT_SCHEMA = "part int, doc_id long, place long, n_tokens long, ids_crc32 long"


def compress(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """Alphabet, rules (pairs of symbols), symbols of the sequence, and rules made per round."""
    present = np.zeros(int(ids.max()) + 1, bool)
    present[ids] = True
    alphabet = np.flatnonzero(present).astype(np.uint32)
    code = np.zeros(len(present), np.int32)
    code[alphabet] = np.arange(len(alphabet), dtype=np.int32)
    seq = code[ids]
    #: Symbols whose expansion ends a document: no pair begins with them.
    closing = alphabet == END_ID
    rules: list[np.ndarray] = []
    made: list[int] = []
    size = len(alphabet)
    live = np.ones(max(len(seq) - 1, 0), bool)
    while len(seq) > 1:
        found = _frequent_pairs(seq, size, live & ~closing[seq[:-1]])
        if found is None:
            break
        pairs, rank, odd = found
        seq, live, kept = _replace(seq, rank, odd, size)
        rules.append(pairs[kept])
        made.append(len(kept))
        closing = np.concatenate([closing, closing[rules[-1][:, 1]]])
        size += len(kept)
    table = np.concatenate(rules) if rules else np.zeros((0, 2), np.int32)
    return alphabet, table, seq, made


def _frequent_pairs(seq: np.ndarray, size: int, live: np.ndarray):
    """The pairs that occur often enough, most frequent first, and the rank of each place's pair.

    Only places in ``live`` are counted. In a run of one symbol every other place is left out, so
    that counts are of pairs that don't overlap; those places are returned as well.
    """
    odd = np.flatnonzero(seq[1:] == seq[:-1])
    if len(odd):
        first = np.concatenate([[True], odd[1:] != odd[:-1] + 1])
        offset = odd - odd[first][np.cumsum(first) - 1]
        odd = odd[offset % 2 == 1]
        live[odd] = False
    at = np.flatnonzero(live)
    if len(at) < LEAST_COUNT:
        return None
    key = seq[at].astype(np.int64) * size + seq[at + 1]
    bits = len(seq).bit_length()
    if (size * size).bit_length() + bits <= 63:
        key = np.sort((key << bits) | at)
        at = key & ((1 << bits) - 1)
        key >>= bits
    else:
        order = np.argsort(key, kind="stable")
        at, key = at[order], key[order]
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    counts = np.diff(np.append(starts, len(key)))
    enough = np.flatnonzero(counts >= LEAST_COUNT)
    if len(enough) == 0:
        return None
    best = np.argsort(-counts[enough], kind="stable")
    rank_of = np.full(len(counts), NONE, np.int32)
    rank_of[enough[best]] = np.arange(len(best), dtype=np.int32)
    rank = np.full(len(seq) - 1, NONE, np.int32)
    rank[at] = np.repeat(rank_of, counts)
    chosen = key[starts[enough[best]]]
    return np.stack([chosen // size, chosen % size], 1).astype(np.int32), rank, odd


def _replace(seq: np.ndarray, rank: np.ndarray, odd: np.ndarray, size: int):
    """Replace each pair that ranks before the pairs it overlaps by its new symbol.

    Pairs left with fewer places than ``LEAST_COUNT`` wait for the next round; the first pair never
    is one of them. Returns the new sequence, its places where a pair may still be frequent (those
    of frequent pairs and those with a new symbol: all others can only lose places), and the ranks
    of the pairs replaced.
    """
    take = rank < RULES_A_ROUND
    take[1:] &= rank[1:] < rank[:-1]
    take[:-1] &= rank[:-1] < rank[1:]
    at = np.flatnonzero(take)
    used = np.bincount(rank[at])
    kept = np.flatnonzero(used >= LEAST_COUNT)
    number = np.full(len(used), -1, np.int32)
    number[kept] = np.arange(len(kept), dtype=np.int32)
    new = number[rank[at]]
    at, new = at[new >= 0], new[new >= 0]
    live = rank != NONE
    live[odd] = live[odd - 1]
    live = np.append(live, False)
    out = seq.copy()
    out[at] = size + new
    keep = np.ones(len(seq), bool)
    keep[at + 1] = False
    out = out[keep]
    live = live[keep][:-1]
    live |= out[:-1] >= size
    live |= out[1:] >= size
    return out, live, kept


def expansion_lengths(n_alphabet: int, rules: np.ndarray, made: list[int]) -> np.ndarray:
    lengths = np.ones(n_alphabet + len(rules), np.int64)
    first = 0
    for n in made:
        pair = rules[first : first + n]
        at = n_alphabet + first
        lengths[at : at + n] = lengths[pair[:, 0]] + lengths[pair[:, 1]]
        first += n
    return lengths


def expand(seq: np.ndarray, alphabet: np.ndarray, rules: np.ndarray) -> np.ndarray:
    """The ids a sequence of symbols stands for: rules applied until none applies."""
    while True:
        new = seq >= len(alphabet)
        at = np.flatnonzero(new)
        if len(at) == 0:
            return alphabet[seq]
        out = np.repeat(seq, 1 + new)
        place = at + np.arange(len(at))
        pair = rules[seq[at] - len(alphabet)]
        out[place], out[place + 1] = pair[:, 0], pair[:, 1]
        seq = out


def pack_shard(doc_ids: list[int | None], texts: list[bytes]) -> bytes:
    """One shard: header, alphabet, rules, lengths, document index and the symbols."""
    ids = np.frombuffer(b"".join(texts), "<u4")
    alphabet, rules, seq, made = compress(ids)
    lengths = expansion_lengths(len(alphabet), rules, made)
    sizes = np.array([len(t) // 4 for t in texts], np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths[seq])])
    symbols = np.searchsorted(starts, np.concatenate([[0], np.cumsum(sizes)]))
    wide = len(lengths) > 65536
    head = struct.pack(
        "<4sIIIQIB", MAGIC, len(texts), len(alphabet), len(rules), len(seq), len(made), wide
    )
    known = np.array([i is not None for i in doc_ids], np.uint8)
    parts = [
        np.array(made, "<u4"),
        alphabet.astype("<u4"),
        rules.astype("<u4"),
        lengths[len(alphabet) :].astype("<u4"),
        known,
        np.array([i or 0 for i in doc_ids], "<i8"),
        sizes.astype("<u4"),
        symbols.astype("<u8"),
        seq.astype("<u4" if wide else "<u2"),
    ]
    return head + b"".join(p.tobytes() for p in parts)


class TokenShard:
    """A shard read back; documents can be decoded one by one, in whole or in part."""

    def __init__(self, payload: bytes) -> None:
        head = "<4sIIIQIB"
        magic, n_docs, n_alphabet, n_rules, n_symbols, n_rounds, wide = struct.unpack_from(
            head, payload
        )
        if magic != MAGIC:
            raise ValueError("not a token shard")
        at = struct.calcsize(head)

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(payload, kind, n, at)
            at += out.nbytes
            return out

        self.made = [int(n) for n in take("<u4", n_rounds)]
        self.alphabet = take("<u4", n_alphabet)
        self.rules = take("<u4", 2 * n_rules).reshape(n_rules, 2).astype(np.int32)
        tail = take("<u4", n_rules).astype(np.int64)
        self.lengths = np.concatenate([np.ones(n_alphabet, np.int64), tail])
        known = take("u1", n_docs)
        ids = take("<i8", n_docs)
        self.doc_ids = [int(i) if k else None for i, k in zip(ids, known, strict=True)]
        self.sizes = take("<u4", n_docs).astype(np.int64)
        self.symbols = take("<u8", n_docs + 1).astype(np.int64)
        self.seq = take("<u4" if wide else "<u2", n_symbols).astype(np.int32)

    def all_ids(self) -> np.ndarray:
        """All ids: each symbol's expansion, made once, is copied to where the symbol stands."""
        symbols = np.arange(len(self.lengths), dtype=np.int32)
        flat = expand(symbols, self.alphabet, self.rules)
        sizes = self.lengths[self.seq]
        ends = np.cumsum(sizes)
        starts = np.cumsum(self.lengths) - self.lengths
        shift = starts[self.seq] - ends + sizes
        return flat[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(shift, sizes)]

    def document(self, i: int, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids start to stop of document ``i``; symbols outside of the range aren't expanded."""
        seq = self.seq[self.symbols[i] : self.symbols[i + 1]]
        stop = int(self.sizes[i]) if stop is None else min(stop, int(self.sizes[i]))
        if start >= stop:
            return np.zeros(0, np.uint32)
        ends = np.cumsum(self.lengths[seq])
        first, last = np.searchsorted(ends, [start, stop - 1], "right")
        skipped = int(ends[first - 1]) if first else 0
        ids = expand(seq[first : last + 1], self.alphabet, self.rules)
        return ids[start - skipped : stop - skipped]


def write_token_files(
    docs: DataFrame, path: str | None = None, name: str = "token-files"
) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into shards in ascending order of doc_id; return the files read back.

    Each row of the files is a shard. A null text has the end id only; a null doc_id comes first;
    rows that repeat a doc_id stand next to each other. Range partitioning spreads the rows, so a
    task holds one shard at a time, and texts cross the network once.
    """
    ship(docs.sparkSession)
    path = path or vocabulary_path()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = chunk_ids(path, REMEMBERED_CHUNKS)
        end = np.array([END_ID], "<u4").tobytes()
        part = TaskContext.get().partitionId()
        doc_ids: list[int | None] = []
        texts: list[bytes] = []
        waiting = shard = start = 0

        def close() -> pa.RecordBatch:
            payload = pack_shard(doc_ids, texts)
            n_symbols = struct.unpack_from("<4sIIIQ", payload)[4]
            row = [part, shard, doc_ids[0], doc_ids[-1], len(texts), start, waiting, n_symbols]
            kinds = [pa.int32(), pa.int32(), *[pa.int64()] * 6, pa.binary()]
            names = [f.split()[0] for f in SHARD_SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip([*row, payload], kinds, strict=True)], names
            )

        for batch in batches:
            for doc_id, text in zip(
                batch.column(0).to_pylist(), batch.column(1), strict=True
            ):
                doc_ids.append(doc_id)
                texts.append(ids.text(text.as_py()) + end)
                waiting += len(texts[-1]) // 4
                if waiting >= SHARD_IDS:
                    yield close()
                    shard, start, waiting, doc_ids, texts = shard + 1, start + waiting, 0, [], []
        if texts:
            yield close()

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    return staged(ordered.mapInArrow(encode, SHARD_SCHEMA), name)


def read_documents(files: DataFrame) -> DataFrame:
    """A row per document, decoded from the files: its place, size and checksum of its ids."""
    ship(files.sparkSession)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, start, payload in zip(
                batch.column(0).to_pylist(),
                batch.column(1).to_pylist(),
                batch.column(2),
                strict=True,
            ):
                shard = TokenShard(payload.as_py())
                raw = memoryview(shard.all_ids().astype("<u4").tobytes())
                ends = np.cumsum(shard.sizes)
                starts = ends - shard.sizes
                crc = [
                    zlib.crc32(raw[4 * s : 4 * e]) for s, e in zip(starts, ends, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(crc), part, np.int32)),
                        pa.array(shard.doc_ids, pa.int64()),
                        pa.array(starts + start),
                        pa.array(shard.sizes),
                        pa.array(crc, pa.int64()),
                    ],
                    ["part", "doc_id", "place", "n_tokens", "ids_crc32"],
                )

    return files.select("part", "part_start", "payload").mapInArrow(decode, DOCUMENT_SCHEMA)


def token_files(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Write token files of ``docs``, read them back and list their documents.

    Returns doc_id, start (ids of all documents before it), n_tokens and ids_crc32. The running
    total is taken over the partitions' sums, one row a partition. A null text has the end id
    only; a null doc_id comes first, rows that repeat a doc_id stand next to each other in any
    order. A text of any length stands in one shard. An empty table gives an empty result; other
    columns are ignored, whatever their names.
    """
    files = write_token_files(docs, path)
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("part_tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select(
        "part", F.coalesce(F.sum("part_tokens").over(before), F.lit(0)).alias("base")
    )
    return (
        read_documents(files)
        .join(base, "part")
        .select("doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")
    )
