"""Helpers the corpus operators share: shipping code, columns as byte arrays, word hashes."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed odd constants of the hash functions.
WORD_BASE = np.uint64(0x9E3779B97F4A7C15)
MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)

#: Texts are cut into runs of whole documents of about this many bytes before array work.
SLICE_BYTES = 1 << 20

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Make this package importable on the executors, as ``--py-files`` would; once a session."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        folder = tempfile.mkdtemp(prefix="casemill-code-")  # read again by late executors
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.addPyFile(
            shutil.make_archive(f"{folder}/casemill_code", "zip", package.parent, package.name)
        )
        _SHIPPED.add(context.applicationId)
    return spark


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` doesn't have, in any letter case."""
    taken = {c.lower() for c in df.columns}
    while stem in taken:
        stem += "_"
    return stem


def id_column(docs: DataFrame) -> Column:
    """doc_id as a long. Without a needless cast, so that two uses of one exchange stay equal."""
    column = F.col("doc_id")
    return column if dict(docs.dtypes)["doc_id"] == "bigint" else column.cast("long").alias("doc_id")


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit integers so that every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * MIX_1
    x ^= x >> np.uint64(27)
    x *= MIX_2
    x ^= x >> np.uint64(31)
    return x


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its n + 1 offsets; a null is an empty text."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def byte_slices(
    offsets: np.ndarray, size: int = SLICE_BYTES
) -> Iterator[tuple[int, int]]:
    """Runs (first, last) of documents of about ``size`` bytes; a longer document stands alone."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(n, max(last, first + 1))
        yield first, last
        first = last


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of each word: a run of bytes other than ASCII white space."""
    space = (data == 32) | ((data >= 9) & (data <= 13))
    word = ~space
    begins = word.copy()
    begins[1:] &= space[:-1]
    ends = word.copy()
    ends[:-1] &= space[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    begins[inner] = word[inner]
    ends[inner - 1] = word[inner - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(offsets, starts, "right") - 1


def lowered(data: np.ndarray) -> np.ndarray:
    """ASCII capitals as small letters; every other byte as it is."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def run_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run data[start:end]; the runs are ascending and not empty."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    firsts = np.cumsum(lengths) - lengths
    within = np.arange(int(lengths.sum())) - np.repeat(firsts, lengths)
    powers = np.ones(int(lengths.max()), np.uint64)
    np.multiply.accumulate(np.full(len(powers) - 1, WORD_BASE), out=powers[1:])
    values = data[within + np.repeat(starts, lengths)].astype(np.uint64) + np.uint64(1)
    values *= powers[within]
    return mix(np.add.reduceat(values, firsts))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document of each word of the texts, letter case of ASCII ignored."""
    starts, ends, docs = word_bounds(data, offsets)
    return run_hash(lowered(data), starts, ends), docs


def shingle_hashes(
    hashes: np.ndarray, docs: np.ndarray, n_docs: int, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of ``width`` successive words and their documents, sorted by document.

    A document of fewer words has one shingle, of all its words; one without words has none.
    """
    counts = np.bincount(docs, minlength=n_docs)
    firsts = np.cumsum(counts) - counts
    made = np.where(counts >= width, counts - width + 1, (counts > 0).astype(counts.dtype))
    owner = np.repeat(np.arange(n_docs), made)
    at = np.arange(int(made.sum())) - np.repeat(np.cumsum(made) - made, made) + firsts[owner]
    total = np.zeros(len(at), np.uint64)
    length = np.minimum(counts[owner], width)
    factor = np.uint64(1)
    padded = np.concatenate([hashes, np.zeros(width, np.uint64)])
    with np.errstate(over="ignore"):
        for j in range(width):
            total += np.where(j < length, padded[at + j], np.uint64(j)) * factor
            factor = factor * WORD_BASE
    total = mix(total)
    order = np.lexsort((total, owner))
    total, owner = total[order], owner[order]
    fresh = np.ones(len(total), bool)
    fresh[1:] = (total[1:] != total[:-1]) | (owner[1:] != owner[:-1])
    return total[fresh], owner[fresh]
