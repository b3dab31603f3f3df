"""Best-fit packing of documents into sequences, improved by swap-based local search.

Pieces are dealt at random into lots of bounded size and each lot is packed by one task: first
best fit by falling length, then a local search over all sequences left underfull. It moves a
document, exchanges one for one, or two for one, whenever that raises the sum of squared fills,
so full sequences get fuller and poor ones empty out, and ends when no such change is left. What
the emptiest sequences of many lots hold is pooled and packed once more.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemill.llm.shared import mix, ship
from casemill.llm.tokens import END_ID, chunk_ids, vocabulary_path
from casemill.session import staged

CAPACITY = 4096
#: Pieces a task packs together; with thousands of them the loss is a few sequences a lot.
LOT_PIECES = 16_384
#: Sequences of each lot whose pieces are pooled, and lots a pool draws from.
POOLED_SEQUENCES = 4
POOL_LOTS = 1_024

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, lot long"


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """Each document's ids with the end id, cut into pieces only if longer than ``capacity``.

    ``lot`` is a random number of the piece, by which lots are dealt.
    """
    ship(docs.sparkSession)
    path = path or vocabulary_path()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = chunk_ids(path)
        end = np.array([END_ID], "<u4").tobytes()
        part = np.uint64(TaskContext.get().partitionId())
        made = 0
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = memoryview(ids.text(text.as_py()) + end)
                n = len(raw) // 4
                for piece, start in enumerate(range(0, n, capacity)):
                    stop = min(n, start + capacity)
                    crc = zlib.crc32(raw[4 * start : 4 * stop])
                    rows.append((doc_id, piece, start, stop - start, crc))
            if not rows:
                continue
            serial = np.arange(made, made + len(rows), dtype=np.uint64)
            lot = mix((part << np.uint64(40)) + serial + np.uint64(1)) >> np.uint64(2)
            made += len(rows)
            columns = list(zip(*rows, strict=True))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(lot.astype(np.int64))],
                [f.split()[0] for f in PIECE_SCHEMA.split(", ")],
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(cut, PIECE_SCHEMA)


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of piece numbers: each piece, longest first, goes where the least room is left over.

    ``open_at[r]`` holds the bins with room r; the set bits of ``rooms`` say which r have any.
    """
    bins: list[list[int]] = []
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        fitting = rooms >> need
        if fitting:
            room = need + (fitting & -fitting).bit_length() - 1
            b = open_at[room].pop()
            if not open_at[room]:
                rooms &= ~(1 << room)
            bins[b].append(i)
        else:
            room, b = capacity, len(bins)
            bins.append([i])
        left = room - need
        if left:
            open_at[left].append(b)
            rooms |= 1 << left
    return bins


class _Outs:
    """What a bin can give away: the sums of one or two of its pieces, indexed by length."""

    def __init__(self, members: list[int], size: list[int], capacity: int) -> None:
        self.by_size: dict[int, list[int]] = {}
        for i in members:
            self.by_size.setdefault(size[i], []).append(i)
        one = np.array(sorted(self.by_size), np.int64)
        twice = [2 * z for z, same in self.by_size.items() if len(same) > 1]
        two = (one[:, None] + one)[np.triu_indices(len(one), 1)]
        sums = np.concatenate([one, two, np.array(twice, np.int64)])
        #: The greatest sum up to each length, and the least sum from each length on.
        self.below = np.zeros(capacity + 1, np.int64)
        self.below[sums] = sums
        np.maximum.accumulate(self.below, out=self.below)
        self.above = np.full(capacity + 1, 4 * capacity, np.int64)
        self.above[sums] = sums
        self.above = np.minimum.accumulate(self.above[::-1])[::-1]

    def pieces(self, total: int) -> list[int]:
        if total in self.by_size:
            return self.by_size[total][:1]
        for z, same in self.by_size.items():
            other = self.by_size.get(total - z)
            if other and (z != total - z or len(same) > 1):
                return [same[0], other[-1]]
        raise ValueError(total)


def local_search(bins: list[list[int]], lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Empty underfull bins by moves, one-for-one and two-for-one exchanges between them.

    Bins are taken up from the poorest, each as long as it has a change that raises the sum of
    squared fills, the greatest first; sweeps over all underfull bins follow each other until one
    finds no change. All pieces of all underfull bins are looked at; a full bin has no such
    change. A bin that is as it was is compared only with bins changed since its last turn.
    """
    size = lengths.tolist()
    bins = [list(b) for b in bins]
    fill = np.array([sum(size[i] for i in b) for b in bins], np.int64)
    log: list[int] = []
    seen: dict[int, int] = {}
    while True:
        under = np.flatnonzero((fill < capacity) & (fill > 0))
        under = under[np.argsort(fill[under], kind="stable")].tolist()
        # A row per piece and one per bin for giving nothing back.
        pieces = [i for k in under for i in bins[k]]
        back = np.array([size[i] for i in pieces] + [0] * len(under), np.int64)
        home = np.array([k for k in under for _ in bins[k]] + under, np.int64)
        row = dict(zip(pieces, range(len(pieces)), strict=True))
        pieces += [-1] * len(under)
        begun = len(log)
        for poor in under:
            while 0 < fill[poor] < capacity:
                since = seen.get(poor, -1)
                news = None if since < 0 else sorted(set(log[since:]) - {poor})
                seen[poor] = len(log)
                if news is not None and len(news) <= len(under) // 4:
                    rows = [row[i] for k in news if fill[k] < capacity for i in bins[k]]
                    if not rows:
                        break
                    # Moves into a changed bin are found with the row of no piece.
                    empty = [k for k in news if 0 < fill[k] < capacity]
                    change = _best_change(
                        _Outs(bins[poor], size, capacity),
                        np.concatenate([back[rows], np.zeros(len(empty), np.int64)]),
                        np.concatenate([home[rows], np.array(empty, np.int64)]),
                        poor, fill, capacity,
                    )
                    at = rows + [-1] * len(empty)
                else:
                    change = _best_change(
                        _Outs(bins[poor], size, capacity), back, home, poor, fill, capacity
                    )
                    at = None
                if not change:
                    break
                where, other, out = change
                given = pieces[where] if at is None else (pieces[at[where]] if at[where] >= 0 else -1)
                for i in out:
                    bins[poor].remove(i)
                    bins[other].append(i)
                    home[row[i]] = other
                if given >= 0:
                    bins[other].remove(given)
                    bins[poor].append(given)
                    home[row[given]] = poor
                shift = sum(size[i] for i in out) - (size[given] if given >= 0 else 0)
                fill[poor] -= shift
                fill[other] += shift
                log += [poor, other]
                # Both have changed, so all their pairs are to be looked at again.
                seen.pop(poor, None)
                seen.pop(other, None)
        if len(log) == begun:
            return [b for b in bins if b]


def _best_change(outs: _Outs, back, home, poor: int, fill, capacity: int):
    """The row, bin and pieces of the greatest gain between bin ``poor`` and the rows' bins.

    For one piece given back, the greatest fitting sum is the best one that fills the other bin,
    and the least fitting sum the best one that fills ``poor``.
    """
    a = int(fill[poor])
    b = fill[home]
    ahead = b - a
    away = outs.below[np.minimum(back + (capacity - b), capacity)]
    shift = away - back
    gain = shift * (ahead + shift)
    gain[(shift <= 0) | (home == poor)] = 0
    best = int(np.argmax(gain)) if len(gain) else 0
    top = int(gain[best]) if len(gain) else 0
    total = int(away[best]) if top > 0 else 0
    near = outs.above[np.maximum(back - (capacity - a), 0)]
    shift = back - near
    gain = shift * (shift - ahead)
    gain[(shift <= 0) | (home == poor)] = 0
    if len(gain) and int(gain.max()) > top:
        best = int(np.argmax(gain))
        top, total = int(gain[best]), int(near[best])
    if top <= 0:
        return None
    return best, int(home[best]), outs.pieces(total)


def pack_lot(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each piece of a lot, and the fill of its bin."""
    bins = local_search(best_fit(lengths, capacity), lengths, capacity)
    which = np.zeros(len(lengths), np.int64)
    offset = np.zeros(len(lengths), np.int64)
    filled = np.zeros(len(lengths), np.int64)
    for k, members in enumerate(bins):
        at = np.cumsum(lengths[members])
        which[members] = k
        offset[members] = at - lengths[members]
        filled[members] = at[-1]
    return which, offset, filled


def _pack_groups(pieces: DataFrame, group: str, base: int, capacity: int) -> DataFrame:
    """Pack each group; ``place`` ranks its bins from the emptiest."""
    schema = (
        "doc_id long, piece int, start long, length long, ids_crc32 long, "
        "grp long, sequence_id long, offset long, place long"
    )

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("lot", kind="stable").reset_index(drop=True)
        which, offset, filled = pack_lot(pdf["length"].to_numpy(), capacity)
        n_bins = int(which.max()) + 1
        fills = np.zeros(n_bins, np.int64)
        fills[which] = filled
        rank = np.empty(n_bins, np.int64)
        rank[np.argsort(fills, kind="stable")] = np.arange(n_bins)
        rank[fills == capacity] = n_bins
        out = pdf[["doc_id", "piece", "start", "length", "ids_crc32", "grp"]].copy()
        out["sequence_id"] = (base + pdf["grp"]) * (1 << 24) + which
        out["offset"] = offset
        out["place"] = rank[which]
        return out

    return (
        pieces.withColumn("grp", F.col(group).cast("long"))
        .select("doc_id", "piece", "start", "length", "ids_crc32", "lot", "grp")
        .groupBy("grp")
        .applyInPandas(pack, schema)
    )


def pack_sequences(
    docs: DataFrame, capacity: int = CAPACITY, path: str | None = None
) -> DataFrame:
    """Pack all ``docs`` (doc_id, text) into sequences of at most ``capacity`` ids.

    Returns a row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. A null
    or empty text is its end id alone; rows that repeat a doc_id are packed each; pieces of full
    length are sequences by themselves. Texts aren't moved: only lengths and checksums are. A null
    doc_id is packed like any other. A text of any length is cut into pieces; pieces of equal
    length may change places, which leaves as many sequences. An empty table gives an empty
    result; other columns are ignored, whatever their names.
    """
    pieces = staged(token_pieces(docs, capacity, path), "pieces")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    whole = (
        pieces.filter(F.col("length") == capacity)
        .withColumn("sequence_id", -F.monotonically_increasing_id() - 1)
        .withColumn("offset", F.lit(0).cast("long"))
        .select(columns)
    )
    parts = pieces.filter(F.col("length") < capacity)
    n_lots = -(-parts.count() // LOT_PIECES) or 1
    first = staged(
        _pack_groups(
            parts.withColumn("in_lot", F.col("lot") % n_lots), "in_lot", 0, capacity
        ),
        "packed",
    )
    if n_lots == 1:
        return whole.unionByName(first.select(columns))
    pooled = F.col("place") < POOLED_SEQUENCES
    again = _pack_groups(
        first.filter(pooled)
        .withColumn("pool", F.floor(F.col("grp") / POOL_LOTS))
        .withColumn("lot", F.xxhash64("sequence_id", "offset")),
        "pool",
        n_lots,
        capacity,
    )
    return whole.unionByName(first.filter(~pooled).select(columns)).unionByName(
        again.select(columns)
    )
