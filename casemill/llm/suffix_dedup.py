"""Removal of long repeated byte strings by suffix arrays made in two stages.

A window is a string of ``WINDOW`` bytes. Its anchor is the gram of ``GRAM`` bytes in it with the
smallest hash, so equal windows have equal anchors wherever they stand, and a run of windows with
one anchor is cut out as one context. Anchors are first matched by their hashes alone; only
contexts whose anchor occurs more than once are gathered, each in the shard of its anchor.

A shard's contexts are one text, whose suffixes are sorted in two stages: only suffixes smaller
than their successors are sorted directly, by their first ``WINDOW`` bytes; all others are put in
place by a scan over the buckets of first bytes, each suffix settling the one before it.
Neighbours whose common prefix is a whole window are equal windows, and those that don't stand in
the document with the smallest doc_id are marked for removal.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemill.llm.shared import WORD_BASE, byte_slices, id_column, mix, ship, utf8
from casemill.session import staged

WINDOW = 50
GRAM = 24
#: Bits of a place within a slice of texts, and of an anchor's number within a batch.
PLACE_BITS = 28
#: A longer text is looked at in parts, which overlap by a window.
LONGEST_PART = 1 << 27
NUMBER_BITS = 24
#: Anchors of a batch after which it is sent off, below two to the NUMBER_BITS by one slice.
BATCH_ANCHORS = 1 << 20
#: Documents whose contexts, or remaining texts, are made together.
TOGETHER = 1_000
#: Bytes of text whose anchors, or contexts, make up a shard on average.
SHARD_BYTES = 8 << 20
_NO_DATA = np.zeros(0, np.int64)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from each place on, by joining hashes of 8 and 16 bytes."""

    def joined(left: np.ndarray, right: np.ndarray, width: int, ahead: int) -> np.ndarray:
        n = len(right) - ahead
        return left[:n] * np.uint64(pow(int(WORD_BASE), width, 2**64)) + right[ahead:]

    one = data.astype(np.uint64) + np.uint64(1)
    two = joined(one, one, 1, 1)
    four = joined(two, two, 2, 2)
    eight = joined(four, four, 4, 4)
    del one, two, four
    sixteen = joined(eight, eight, 8, 8)
    return mix(joined(sixteen, eight, 8, 16))


def anchors(data: np.ndarray, offsets: np.ndarray):
    """Runs of windows with one anchor: hash of the anchor, document, first window, windows.

    A slice longer than ``LONGEST_PART`` is one text; a run that crosses two of its parts is two.
    """
    if len(data) > LONGEST_PART:
        parts = []
        for start in range(0, len(data) - WINDOW + 1, LONGEST_PART - WINDOW + 1):
            part = data[start : start + LONGEST_PART]
            hashes, owner, first, n = anchors(part, np.array([0, len(part)]))
            parts.append((hashes, owner, first + start, n))
        return tuple(np.concatenate(c) for c in zip(*parts, strict=True))
    span = WINDOW - GRAM + 1
    empty = np.zeros(0, np.uint64), _NO_DATA, _NO_DATA, _NO_DATA
    if len(data) < WINDOW:
        return empty
    grams = gram_hashes(data)
    place = np.uint64((1 << PLACE_BITS) - 1)
    least = (grams & ~place) | np.arange(len(grams), dtype=np.uint64)
    width = 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = span - width
    if rest:
        least = np.minimum(least[:-rest], least[rest:])
    chosen = (least & place).astype(np.int64)
    # Windows that end in another document are none.
    lengths = np.diff(offsets)
    whole = np.ones(len(chosen), bool)
    for end in offsets[1:-1][lengths[:-1] > 0]:
        whole[max(0, end - WINDOW + 1) : end] = False
    windows = np.flatnonzero(whole)
    if not len(windows):
        return empty
    chosen = chosen[windows]
    fresh = np.ones(len(windows), bool)
    # The same gram may be chosen across a gap only if its document is the same, without a gap.
    fresh[1:] = (chosen[1:] != chosen[:-1]) | (windows[1:] != windows[:-1] + 1)
    starts = np.flatnonzero(fresh)
    first = windows[starts]
    owner = np.searchsorted(offsets, first, "right") - 1
    return (
        grams[chosen[starts]],
        owner,
        first - offsets[owner],
        np.diff(np.append(starts, len(windows))),
    )


def two_stage_order(
    text: np.ndarray, words: np.ndarray, begins: np.ndarray, ends: np.ndarray, owned: np.ndarray
) -> np.ndarray:
    """Suffixes in order by their first WINDOW bytes.

    Contexts stand in ``text`` from begins to ends, each closed by a 0, and the first ``owned``
    suffixes of each are wanted. Some after them are sorted as well, as far as the first one that
    is smaller than its successor: from there on the wanted ones are settled.
    """
    step = np.zeros(len(text), np.int8)
    step[:-1] = np.sign(text[1:].astype(np.int16) - text[:-1])
    step[ends] = 1  # the closing 0 is smaller than anything after it
    differs = np.flatnonzero(step)  # the last one is the end of the last context
    rising = np.repeat(step[differs] > 0, np.diff(differs, prepend=-1))
    up = np.flatnonzero(rising)
    last = up[np.searchsorted(up, begins + owned)]
    count = last - begins + 1
    at = np.repeat(begins, count) + np.arange(int(count.sum())) - np.repeat(
        np.cumsum(count) - count, count
    )
    is_first = np.zeros(len(text), bool)
    is_first[begins] = True
    direct = at[rising[at]]
    direct = direct[_direct_order(words, direct, np.repeat(ends, count)[rising[at]])]
    heads = text[direct]
    cuts = np.searchsorted(heads, np.arange(257))
    falling: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []
    for c in range(256):
        part = np.concatenate([_NO_DATA, *falling[c]])
        parts = [part]
        while len(part):
            before = part[~is_first[part]] - 1
            part = before[text[before] == c]
            parts.append(part)
        bucket = np.concatenate([*parts, direct[cuts[c] : cuts[c + 1]]])
        falling[c] = []
        if not len(bucket):
            continue
        out.append(bucket)
        before = bucket[~is_first[bucket]] - 1
        before = before[text[before] > c]
        head = text[before]
        order = np.argsort(head, kind="stable")
        before, head = before[order], head[order]
        edges = np.flatnonzero(np.diff(head)) + 1
        for piece in np.split(before, edges):
            if len(piece):
                falling[text[piece[0]]].append(piece)
    return np.concatenate(out) if out else _NO_DATA


def _words_of(words: np.ndarray, at: np.ndarray, ends: np.ndarray, j: int) -> np.ndarray:
    """Word j (8 bytes, the first the highest) of each suffix; 0 beyond its end and the window."""
    left = np.clip(np.minimum(ends - at, WINDOW) - 8 * j, 0, 8).astype(np.uint64)
    shift = np.uint64(64) - np.uint64(8) * left
    value = words[np.minimum(at + 8 * j, len(words) - 1)].astype(np.uint64)
    shift = np.minimum(shift, np.uint64(63))
    return np.where(left > 0, value >> shift << shift, np.uint64(0))


def _direct_order(words: np.ndarray, at: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Order of suffixes by their first WINDOW bytes: by 16 bytes, and groups that differ further
    on by the rest of them."""
    n_words = -(-WINDOW // 8)
    keys = [_words_of(words, at, ends, j) for j in range(2)]
    order = np.lexsort((keys[1], keys[0]))
    if len(at) < 2:
        return order
    equal = np.ones(len(at) - 1, bool)
    for key in keys:
        s = key[order]
        equal &= s[1:] == s[:-1]
    rest = [_words_of(words, at[order], ends[order], j) for j in range(2, n_words)]
    alike = np.ones(len(at) - 1, bool)
    for key in rest:
        alike &= key[1:] == key[:-1]
    group = np.concatenate([[0], np.cumsum(~equal)])
    mixed = np.zeros(int(group[-1]) + 1, bool)
    mixed[group[1:][equal & ~alike]] = True
    places = np.flatnonzero(mixed[group])
    if len(places):
        again = np.lexsort([key[places] for key in reversed(rest)] + [group[places]])
        order[places] = order[places[again]]
    return order


def equal_windows(contexts: list[bytes], owned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The wanted suffixes of all contexts in order (places in the joined text, one byte added to
    each context), and whether each is a window equal to the one before it."""
    joined = np.frombuffer(b"\xff".join(contexts) + b"\xff", np.uint8)
    text = joined + np.uint8(1)  # UTF-8 has no byte 255: the closing byte becomes 0
    lengths = np.array([len(c) for c in contexts], np.int64)
    ends = np.cumsum(lengths + 1) - 1
    begins = ends - lengths
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    # The eight bytes from each place on as a number, the first the highest: a view, no copy.
    words = np.ndarray(len(text), ">u8", padded, strides=(1,))
    order = two_stage_order(text, words, begins, ends, owned)
    context = np.searchsorted(ends, order)
    wanted = order - begins[context] < owned[context]
    order, context = order[wanted], context[wanted]
    same = np.zeros(len(order), bool)
    if len(order):
        equal = np.ones(len(order) - 1, bool)
        for j in range(-(-WINDOW // 8)):
            key = _words_of(words, order, ends[context], j)
            equal &= key[1:] == key[:-1]
        same[1:] = equal
    return order, same


# --- Spark -----------------------------------------------------------------------------------


def _anchor_batches(shards: int):
    """Per batch and shard the anchors' hash bits and numbers, and a row listing the documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 24
        serial = 0
        keys: list[np.ndarray] = []
        table: list[tuple] = []
        waiting = 0

        def send() -> pa.RecordBatch:
            nonlocal serial, keys, table, waiting
            hashes = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
            low = np.uint64((1 << NUMBER_BITS) - 1)
            packed = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
            shard = (hashes & np.uint64(shards - 1)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            cuts = np.searchsorted(shard[order], np.arange(shards + 1))
            packed = packed[order]
            batch = part + serial
            rows = [(-1 - batch, batch, b"".join(x.tobytes() for x in columns(table)))]
            rows += [
                (k, batch, packed[cuts[k] : cuts[k + 1]].tobytes())
                for k in range(shards)
                if cuts[k + 1] > cuts[k]
            ]
            serial, keys, table, waiting = serial + 1, [], [], 0
            names = ["shard", "batch", "payload"]
            kinds = [pa.int64(), pa.int64(), pa.binary()]
            arrays = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names)

        def columns(table):
            return [np.concatenate([t[i] for t in table]) for i in range(3)]

        for batch in batches:
            data, offsets = utf8(batch.column(2))
            ids = batch.column(0).to_numpy()
            marks = batch.column(1).to_numpy()
            for first, last in byte_slices(offsets):
                at = offsets[first : last + 1] - offsets[first]
                hashes, owner, _, _ = anchors(data[offsets[first] : offsets[last]], at)
                if waiting and waiting + len(hashes) > BATCH_ANCHORS:
                    yield send()
                if len(hashes) >= 1 << NUMBER_BITS:
                    raise ValueError("a text has more anchors than a batch can number")
                keys.append(hashes)
                counts = np.bincount(owner, minlength=last - first)
                table.append((ids[first:last], marks[first:last], counts))
                waiting += len(hashes)
        if table:
            yield send()

    return run


def _repeated_anchors(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted by shard: numbers of the anchors that occur more than once, by batch."""
    kept: list[tuple[int, bytes]] = []
    now = None

    def found() -> pa.RecordBatch:
        packed = np.concatenate([np.frombuffer(p, np.uint64) for _, p in kept])
        batch = np.repeat([b for b, _ in kept], [len(p) // 8 for _, p in kept])
        key = packed >> np.uint64(NUMBER_BITS)
        order = np.argsort(key, kind="stable")
        key = key[order]
        again = np.zeros(len(key), bool)
        again[1:] = key[1:] == key[:-1]
        again[:-1] |= again[1:]
        order = np.sort(order[again])
        number = (packed[order] & np.uint64((1 << NUMBER_BITS) - 1)).astype(np.uint32)
        batch = batch[order]
        cuts = np.flatnonzero(np.diff(batch)) + 1
        pieces = np.split(number, cuts) if len(number) else []
        firsts = np.append(0, cuts)[: len(pieces)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(batch[firsts] if len(pieces) else _NO_DATA),
                pa.array(np.ones(len(pieces), bool)),
                pa.array([p.tobytes() for p in pieces], pa.binary()),
            ],
            ["batch", "numbers", "payload"],
        )

    for rb in rows:
        for shard, batch, payload in zip(*(c.to_pylist() for c in rb.columns), strict=True):
            if shard < 0:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([batch], pa.int64()),
                        pa.array([False]),
                        pa.array([payload], pa.binary()),
                    ],
                    ["batch", "numbers", "payload"],
                )
                continue
            if shard != now and kept:
                yield found()
                kept = []
            now = shard
            kept.append((batch, payload))
    if kept:
        yield found()


def _by_document(table: pa.Table) -> pa.Table:
    """Of one batch: which anchors of each document are repeated, counted within the document."""
    numbers = [np.zeros(0, np.uint32)]
    listing = b""
    for is_numbers, payload in zip(
        table["numbers"].to_pylist(), table["payload"].to_pylist(), strict=True
    ):
        if is_numbers:
            numbers.append(np.frombuffer(payload, np.uint32))
        else:
            listing = payload
    columns = np.frombuffer(listing, np.int64).reshape(3, -1)
    ends = np.cumsum(columns[2])
    number = np.sort(np.concatenate(numbers)).astype(np.int64)
    owner = np.searchsorted(ends, number, "right")
    cuts = np.searchsorted(owner, np.arange(columns.shape[1] + 1))
    some = np.flatnonzero(np.diff(cuts))
    local = (number - (ends - columns[2])[owner]).astype(np.uint32)
    return pa.table(
        {
            "doc_id": pa.array(columns[0][some]),
            "mark": pa.array(columns[1][some]),
            "repeated": pa.array(
                [local[cuts[d] : cuts[d + 1]].tobytes() for d in some], pa.binary()
            ),
        }
    )


def _smaller(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, TOGETHER):
            yield batch.slice(first, TOGETHER)


def _context_batches(shards: int):
    """Per batch and shard the contexts of repeated anchors, compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _smaller(batches):
            data, offsets = utf8(batch.column(1))
            ids = batch.column(0).to_numpy()
            repeated = batch.column(2).to_pylist()
            versions = batch.column(3).to_numpy()
            found: list[tuple] = []
            for first, last in byte_slices(offsets):
                at = offsets[first : last + 1] - offsets[first]
                hashes, owner, start, windows = anchors(data[offsets[first] : offsets[last]], at)
                counts = np.bincount(owner, minlength=last - first)
                before = np.cumsum(counts) - counts
                picks = [
                    np.frombuffer(r, np.uint32) + b
                    for r, b in zip(repeated[first:last], before, strict=True)
                ]
                pick = np.concatenate(picks) if picks else _NO_DATA
                found.append(
                    (hashes[pick], owner[pick] + first, start[pick], windows[pick])
                )
            if not found:
                continue
            hashes, owner, start, windows = (
                np.concatenate(c) for c in zip(*found, strict=True)
            )
            shard = (hashes & np.uint64(shards - 1)).astype(np.int64)
            order = np.lexsort((hashes, shard))
            cuts = np.searchsorted(shard[order], np.arange(shards + 1))
            raw = data.tobytes()
            rows = []
            for k in range(shards):
                own = order[cuts[k] : cuts[k + 1]]
                if not len(own):
                    continue
                begin = offsets[owner[own]] + start[own]
                size = windows[own] + WINDOW - 1
                pieces = [raw[b : b + s] for b, s in zip(begin.tolist(), size.tolist(), strict=True)]
                head = np.concatenate(
                    [ids[owner[own]], versions[owner[own]], start[own], windows[own]]
                ).tobytes()
                body = head + b"".join(pieces)
                rows.append((k, len(own), len(body), pa.compress(body, "zstd", asbytes=True)))
            if rows:
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)],
                    ["shard", "contexts", "size", "payload"],
                )

    return run


def _repeated_spans(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted by shard: spans of windows that also stand in a document with a smaller doc_id."""
    kept: list[tuple[int, int, bytes]] = []
    now = None
    for rb in rows:
        for shard, n, size, payload in zip(*(c.to_pylist() for c in rb.columns), strict=True):
            if shard != now and kept:
                yield _shard_spans(kept)
                kept = []
            now = shard
            kept.append((n, size, payload))
    if kept:
        yield _shard_spans(kept)


def _shard_spans(kept: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    heads, pieces = [], []
    for n, size, payload in kept:
        body = pa.decompress(payload, size, "zstd", asbytes=True)
        head = np.frombuffer(body, np.int64, 4 * n).reshape(4, n)
        heads.append(head)
        ends = np.cumsum(head[3] + WINDOW - 1) + 32 * n
        begins = ends - (head[3] + WINDOW - 1)
        pieces += [body[b:e] for b, e in zip(begins.tolist(), ends.tolist(), strict=True)]
    docs, versions, start, windows = np.concatenate(heads, axis=1)
    # Equal contexts are sorted once; only the smallest document of each matters to the others.
    numbers: dict[bytes, int] = {}
    which = np.fromiter(
        (numbers.setdefault(p, len(numbers)) for p in pieces), np.int64, len(pieces)
    )
    owned = np.zeros(len(numbers), np.int64)
    owned[which] = windows
    lowest = np.full(len(numbers), np.iinfo(np.int64).max)
    np.minimum.at(lowest, which, docs)
    order, same = equal_windows(list(numbers), owned)
    first_place = np.cumsum(owned + WINDOW) - (owned + WINDOW)
    context = np.searchsorted(first_place, order, "right") - 1
    groups = np.flatnonzero(~same)
    least = np.repeat(
        np.minimum.reduceat(lowest[context], groups), np.diff(np.append(groups, len(order)))
    )
    # The smallest document of the window at each place of each context.
    slot = np.cumsum(owned) - owned
    smallest = np.zeros(int(owned.sum()), np.int64)
    smallest[slot[context] + order - first_place[context]] = least
    total = int(windows.sum())
    at = np.repeat(np.arange(len(docs)), windows)
    inner = np.arange(total) - np.repeat(np.cumsum(windows) - windows, windows)
    marked = smallest[slot[which[at]] + inner] < docs[at]
    edge = np.ones(total, bool)
    edge[1:] = (marked[1:] != marked[:-1]) | (at[1:] != at[:-1])
    firsts = np.flatnonzero(edge)
    length = np.diff(np.append(firsts, total))
    firsts, length = firsts[marked[firsts]], length[marked[firsts]]
    begin = start[at[firsts]] + inner[firsts]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(docs[at[firsts]]),
            pa.array(versions[at[firsts]]),
            pa.array(begin),
            pa.array(begin + length + WINDOW - 1),
        ],
        ["doc_id", "version", "first", "last"],
    )


REMOVED_SCHEMA = (
    "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text binary"
)


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _smaller(batches):
        rows = []
        for doc_id, text, whole, spans in zip(
            batch.column(0).to_pylist(),
            batch.column(1),
            batch.column(2).to_pylist(),
            batch.column(3).to_pylist(),
            strict=True,
        ):
            raw = (text.as_py() or "").encode()
            merged: list[list[int]] = []
            if whole:
                spans = [{"first": 0, "last": len(raw)}] if len(raw) >= WINDOW else []
            for s in sorted(spans or [], key=lambda s: s["first"]):
                if merged and s["first"] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], s["last"])
                else:
                    merged.append([s["first"], s["last"]])
            parts, done = [], 0
            for first, last in merged:
                parts.append(raw[done:first])
                done = last
            left = b"".join([*parts, raw[done:]])
            digest = hashlib.sha256(left).hexdigest()
            rows.append((doc_id, len(raw), len(raw) - len(left), len(merged), digest, left))
        if rows:
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)],
                [f.split()[0] for f in REMOVED_SCHEMA.split(", ")],
            )


def _shards(n_bytes: int) -> int:
    """A power of two, so that the low bits of a hash name the shard."""
    return 1 << max(0, -(-n_bytes // SHARD_BYTES) - 1).bit_length()


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) without the bytes that a 50-byte string of a smaller doc_id covers.

    Returns a row per input row: doc_id, n_bytes, n_removed, n_spans (maximal removed runs),
    kept_sha256 and kept_text (the remaining bytes). Strings are judged on the input. A null text
    is empty; rows without doc_id lose nothing and cover nothing; rows that repeat a doc_id don't
    cover one another, and each loses what its own text repeats. A copy of a whole text goes whole
    if it has 50 bytes. Texts cross the network once, for both the contexts and the removal; one of
    more than ``LONGEST_PART`` bytes is looked at in parts. A text with more anchors than
    2^NUMBER_BITS (about 200 MB) is refused with an error. An empty table gives an empty result;
    other columns are ignored, whatever their names.
    """
    ship(docs.sparkSession)
    rows = docs.select(
        id_column(docs), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    ).withColumn("mark", F.xxhash64("text"))
    known = rows.filter("doc_id IS NOT NULL")
    prints = staged(
        known.select(
            "doc_id",
            "mark",
            F.xxhash64(F.lit(1), "text").alias("mark2"),
            F.octet_length("text").alias("n_bytes"),
        ),
        "prints",
    )
    same_text = ["mark", "mark2", "n_bytes"]
    firsts = prints.groupBy(*same_text).agg(F.min("doc_id").alias("first_id"))
    # Rows may repeat a doc_id with other texts: all but one of its marks are versions.
    several = (
        prints.groupBy("doc_id")
        .agg(F.min("mark").alias("least"), F.max("mark").alias("greatest"))
        .filter("least < greatest")
        .select("doc_id", "least")
    )
    origin = staged(
        prints.join(firsts, same_text)
        .groupBy("doc_id", "mark")
        .agg(F.max(F.col("doc_id") > F.col("first_id")).alias("whole"))
        .join(several, "doc_id", "left")
        .select(
            "doc_id",
            "mark",
            "whole",
            F.when(F.col("mark") > F.col("least"), F.col("mark")).otherwise(0).alias("version"),
        ),
        "origins",
    )
    total = prints.agg(F.sum("n_bytes")).first()[0] or 0
    shards = _shards(int(total))

    sent = known.select("doc_id", "mark", "text").mapInArrow(
        _anchor_batches(shards), "shard long, batch long, payload binary"
    )
    answered = (
        sent.repartition("shard")
        .sortWithinPartitions("shard")
        .mapInArrow(_repeated_anchors, "batch long, numbers boolean, payload binary")
    )
    repeated = (
        answered.groupBy("batch")
        .applyInArrow(_by_document, "doc_id long, mark long, repeated binary")
        .join(origin.filter(~F.col("whole")).select("doc_id", "mark", "version"), ["doc_id", "mark"])
        .dropDuplicates(["doc_id", "mark"])
    )
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = known.select("doc_id", "mark", "text").repartition(n, "doc_id", "mark")
    contexts = (
        texts.join(repeated.hint("shuffle_hash"), ["doc_id", "mark"])
        .select("doc_id", "text", "repeated", "version")
        .mapInArrow(
            _context_batches(shards), "shard long, contexts long, size long, payload binary"
        )
    )
    spans = (
        contexts.repartition("shard")
        .sortWithinPartitions("shard")
        .mapInArrow(_repeated_spans, "doc_id long, version long, first long, last long")
        .groupBy("doc_id", "version")
        .agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    )
    marked = (
        origin.join(spans, ["doc_id", "version"], "left")
        .filter("whole OR spans IS NOT NULL")
        .select("doc_id", "mark", "whole", "spans")
    )
    judged = texts.join(marked, ["doc_id", "mark"], "left").select(
        "doc_id", "text", "whole", "spans"
    )
    unknown = rows.filter("doc_id IS NULL").select(
        "doc_id",
        "text",
        F.lit(False).alias("whole"),
        F.lit(None).cast("array<struct<first:bigint,last:bigint>>").alias("spans"),
    )
    return judged.unionByName(unknown).mapInArrow(_remove, REMOVED_SCHEMA)
