"""Product quantisation of vectors in integers, by Lloyd rounds over active entries only.

Vectors become integers and are cut into equal parts; each part position has a codebook. A round
assigns every part to its nearest entry and moves each entry to the floor of its parts' mean. The
state of a part is its entry and the exact distance to it. In a later round a part whose entry
stayed fixed compares only the entries that moved with its stored distance: any other entry is as
far away as before, when it lost. A part whose entry moved looks at all entries. Ties go to the
lower index, also between a stored and a new distance, so the codes are those of full rounds.

Vectors travel in blocks, a row of packed arrays each. A round reads the blocks with their state
and writes them with the new state to the shared folder, from which a lost executor's work is
redone; the folder before the last is then removed. Each task adds one row of sums. The driver
holds the codebooks and their sums, ``PARTS * ENTRIES`` entries whatever the input.

Defined results: a vector that is null or empty, or holds a null or non-finite component, is
dropped; so is one whose width differs from that of the row with the smallest vec_id (nulls last).
Parts of a width that ``PARTS`` doesn't divide are filled with zeros at the end. Integers are held
to +-``LARGEST`` (components of about 16,000). Rows that repeat a vec_id each stand for themselves,
in the order of their components where the first entries are chosen; a null vec_id comes last
there. Fewer than ``ENTRIES`` vectors make as many entries. Null labels count as equal. An empty
table gives an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemill.llm.shared import ship
from casemill.session import remove_staged, staging_path, written

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
LARGEST = 1 << 26
#: Vectors of one block.
BLOCK = 8192
#: Largest number that a double holds exactly with all its smaller ones.
_EXACT = 1 << 53

_STATE = "ids binary, id_nulls binary, labels binary, label_nulls binary, parts binary, codes binary, far binary, sums array<long>"


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared Euclidean distances of integer rows to integer entries, exact."""
    if len(x) == 0 or len(entries) == 0:
        return np.zeros((len(x), len(entries)), np.int64)
    largest = max(int(np.abs(x).max()), int(np.abs(entries).max()))
    if 4 * largest * largest * x.shape[1] < _EXACT:  # every sum below is exact in doubles
        a, b = x.astype(np.float64), entries.astype(np.float64)
        near = (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None]
        return near.astype(np.int64)
    return np.stack([((x.astype(np.int64) - e) ** 2).sum(1) for e in entries], 1)


def assign(
    x: np.ndarray, entries: np.ndarray, moved: np.ndarray, code: np.ndarray, far: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """New entry and distance of each row; ``code`` and ``far`` are those before ``moved`` moved."""
    code, far = code.copy(), far.copy()
    lost = moved[code]
    if lost.any():
        near = distances(x[lost], entries)
        best = near.argmin(1)  # the first of equal ones
        code[lost], far[lost] = best, near[np.arange(len(best)), best]
    active = np.flatnonzero(moved)
    kept = np.flatnonzero(~lost)
    if len(active) and len(kept):
        near = distances(x[kept], entries[active])
        best = near.argmin(1)
        near, best = near[np.arange(len(best)), best], active[best]
        wins = (near < far[kept]) | ((near == far[kept]) & (best < code[kept]))
        at = kept[wins]
        code[at], far[at] = best[wins], near[wins]
    return code, far


def _integers(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors are kept, and the scaled integers of those."""
    column = column.cast(pa.large_list(pa.float64()))
    sizes = np.asarray(pc.fill_null(pc.list_value_length(column), -1), np.int64)
    whole = np.flatnonzero(sizes == width)
    values = column.take(pa.array(whole)).flatten()
    x = np.asarray(pc.fill_null(values, np.nan), np.float64).reshape(len(whole), width)
    finite = np.isfinite(x).all(1)
    x = np.floor(x[finite] * SCALE)
    return whole[finite], np.clip(x, -LARGEST, LARGEST).astype(np.int32)


def _padded(x: np.ndarray, parts: int) -> np.ndarray:
    """Rows cut into parts: (rows, parts, width of a part), zeros at the end."""
    wide = -(-x.shape[1] // parts)
    out = np.zeros((len(x), parts * wide), np.int32)
    out[:, : x.shape[1]] = x
    return out.reshape(len(x), parts, wide)


def _longs(column: pa.Array) -> tuple[bytes, bytes]:
    """A long column as packed numbers and marks of nulls."""
    nulls = np.asarray(column.is_null().to_numpy(zero_copy_only=False), bool)
    return np.asarray(pc.fill_null(column, 0), np.int64).tobytes(), nulls.tobytes()


def _round(blocks: DataFrame, books: np.ndarray, moved: np.ndarray, last: bool) -> DataFrame:
    """Assign every part of the blocks; the rows of sums have no ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, entries, wide = books.shape
        sums = np.zeros((parts, entries, wide + 1), np.int64)
        line = pa.schema(
            [(f.split()[0], pa.binary()) for f in _STATE.split(", ")[:-1]]
            + [("sums", pa.list_(pa.int64()))]
        )
        for batch in batches:
            for row in batch.to_pylist():
                x = np.frombuffer(row["parts"], np.int32).reshape(-1, parts, wide)
                first = row["codes"] is None
                codes = np.zeros((len(x), parts), np.uint8)
                far = np.zeros((len(x), parts), np.int64)
                old = codes if first else np.frombuffer(row["codes"], np.uint8).reshape(-1, parts)
                was = far if first else np.frombuffer(row["far"], np.int64).reshape(-1, parts)
                for p in range(parts):
                    active = np.ones(entries, bool) if first else moved[p]
                    codes[:, p], far[:, p] = assign(
                        x[:, p], books[p], active, old[:, p], was[:, p]
                    )
                    if last:
                        continue
                    for e in np.unique(codes[:, p]):
                        mine = x[codes[:, p] == e, p]
                        sums[p, e, :wide] += mine.sum(0, dtype=np.int64)
                        sums[p, e, wide] += len(mine)
                row |= {"codes": codes.tobytes(), "far": far.tobytes()}
                yield pa.RecordBatch.from_pylist([row], line)
        if sums[..., -1].any():
            yield pa.RecordBatch.from_pylist([{"sums": sums.ravel().tolist()}], line)

    return blocks.mapInArrow(run, _STATE)


def _total(blocks: DataFrame) -> list[int]:
    """The tasks' sums added up: as many numbers as the codebooks have, whatever the input."""
    rows = (
        blocks.filter("sums is not null")
        .select(F.posexplode("sums").alias("at", "value"))
        .groupBy("at")
        .agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("total"))
        .collect()
    )
    return [int(r.total) for r in sorted(rows, key=lambda r: r["at"])]


class VectorCodes:
    """Codebooks (parts, entries, width of a part) and the blocks of coded vectors."""

    def __init__(self, books: np.ndarray, blocks: DataFrame | None) -> None:
        self.books = books
        self.blocks = blocks

    def digest(self) -> str:
        """SHA-256 of all entries' components by part, entry and position, comma-joined."""
        return hashlib.sha256(",".join(map(str, self.books.ravel().tolist())).encode()).hexdigest()


def fit_codes(
    vectors: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> VectorCodes:
    """Codebooks after ``rounds`` rounds, and every kept vector of ``vectors`` coded by them.

    ``vectors`` has vec_id, embedding and label.
    """
    spark = ship(vectors.sparkSession)
    rows = vectors.select(
        F.col("vec_id").cast("long"),
        F.col("embedding").cast("array<double>"),
        F.col("label").cast("long"),
    )
    sound = F.col("embedding").isNotNull() & (F.size("embedding") > 0) & F.forall(
        "embedding", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))) & ~F.isnan(x)
    )
    order = [F.col("vec_id").asc_nulls_last(), F.col("embedding")]
    head = rows.filter(sound).orderBy(*order).limit(1).collect()
    width = len(head[0].embedding) if head else 0
    if not width:
        return VectorCodes(np.zeros((parts, 0, 0), np.int64), None)
    first = rows.filter(sound & (F.size("embedding") == width)).orderBy(*order).limit(entries)
    _, start = _integers(
        pa.array([r.embedding for r in first.collect()], pa.list_(pa.float64())), width
    )
    books = _padded(start, parts).transpose(1, 0, 2).astype(np.int64)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                kept, x = _integers(part.column(1), width)
                if not len(kept):
                    continue
                take = pa.array(kept)
                ids, id_nulls = _longs(part.column(0).take(take))
                labels, label_nulls = _longs(part.column(2).take(take))
                packed = [ids, id_nulls, labels, label_nulls, _padded(x, parts).tobytes()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], pa.binary()) for v in [*packed, None, None]]
                    + [pa.array([None], pa.list_(pa.int64()))],
                    [f.split()[0] for f in _STATE.split(", ")],
                )

    blocks = rows.mapInArrow(pack, _STATE)
    moved = np.ones(books.shape[:2], bool)
    before = None
    for step in range(rounds + 1):
        path = staging_path(spark, "vector-codes")
        blocks = written(_round(blocks, books, moved, step == rounds), path)
        if before:
            remove_staged(spark, before)
        before = path
        if step == rounds:
            break
        sums = np.array(_total(blocks), object).reshape(*books.shape[:2], -1)
        counts, old = sums[..., -1:], books
        used = (counts > 0)[..., 0]
        means = sums[..., :-1] // np.where(counts > 0, counts, 1)  # floor, below zero as well
        books = np.where(used[..., None], means, old).astype(np.int64)
        moved = (books != old).any(2)
        blocks = blocks.filter("ids is not null")
    return VectorCodes(books, blocks)


def coded_vectors(fitted: VectorCodes, spark) -> DataFrame:
    """vec_id, label, codes (binary, a byte a part) and error of every coded vector."""
    schema = "vec_id long, label long, codes binary, error long"
    if fitted.blocks is None:
        return spark.createDataFrame([], schema)
    parts = len(fitted.books)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                error = np.frombuffer(row["far"], np.int64).reshape(-1, parts).sum(1)
                ends = np.arange(len(error) + 1, dtype=np.int32) * parts
                codes = pa.Array.from_buffers(
                    pa.binary(), len(error), [None, pa.py_buffer(ends), pa.py_buffer(row["codes"])]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(
                            np.frombuffer(row[name], np.int64),
                            mask=np.frombuffer(row[marks], bool),
                        )
                        for name, marks in (("ids", "id_nulls"), ("labels", "label_nulls"))
                    ]
                    + [codes, pa.array(error)],
                    ["vec_id", "label", "codes", "error"],
                )

    packed = fitted.blocks.filter("ids is not null").select(
        "ids", "id_nulls", "labels", "label_nulls", "codes", "far"
    )
    return packed.mapInArrow(unpack, schema)


def decoded_vectors(coded: DataFrame, books: np.ndarray, width: int) -> DataFrame:
    """vec_id and embedding (array of double): the entries that stand for each coded vector."""
    ship(coded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = np.arange(len(books))
        for batch in batches:
            codes = np.array([list(c.as_py()) for c in batch.column(1)], np.int64)
            x = books[parts, codes.reshape(-1, len(books))].reshape(len(codes), -1)[:, :width]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(list(x / SCALE), pa.list_(pa.float64()))],
                ["vec_id", "embedding"],
            )

    return coded.select("vec_id", "codes").mapInArrow(run, "vec_id long, embedding array<double>")


def compress_vectors(vectors: DataFrame) -> DataFrame:
    """A row per kept vector: vec_id, code, error, label_error and codebooks_sha256.

    The errors of a label are summed before they are joined back; Spark splits a label that holds
    many rows in that join.
    """
    fitted = fit_codes(vectors)
    coded = coded_vectors(fitted, vectors.sparkSession)
    most = F.lit(2**63 - 1).cast("decimal(38,0)")
    sums = coded.groupBy("label").agg(
        F.least(F.sum(F.col("error").cast("decimal(38,0)")), most).cast("long").alias("label_error")
    )
    # A null label meets itself through a mark of its own.
    keyed = coded.withColumn("marked", F.coalesce("label", F.lit(0))).withColumn(
        "absent", F.col("label").isNull()
    )
    sums = sums.select(
        F.coalesce("label", F.lit(0)).alias("marked"),
        F.col("label").isNull().alias("absent"),
        "label_error",
    )
    return keyed.join(sums, ["marked", "absent"]).select(
        "vec_id",
        F.lower(F.hex("codes")).alias("code"),
        "error",
        "label_error",
        F.lit(fitted.digest()).alias("codebooks_sha256"),
    )
