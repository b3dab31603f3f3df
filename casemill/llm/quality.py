"""Quality scores: ridge regression on random Fourier features of document statistics.

Statistics of whole texts are scaled and mapped to random Fourier features, whose inner products
approximate a Gaussian kernel. Each partition sums its part of the normal equations of the
labelled rows; their total, of fixed size, is solved on the driver. Isotonic regression on a
histogram of the training scores turns scores into rates of label 1.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemill.llm.shared import byte_slices, lowered, run_hash, ship, utf8, word_bounds
from casemill.session import staged

FEATURES = 384
RIDGE = 1e-3
SEED = 6
CUT = 0.3
#: Steps of the score histogram that the isotonic regression is fitted on.
STEPS = 1_024
#: Learn from documents whose checksum has another remainder than HELD_OUT by FOLDS.
FOLDS, HELD_OUT = 5, 0

# Frequent words of the four languages.
FREQUENT_WORDS = (
    "the of and to in is that for it was on are as with be by this der die das und ist von den mit "
    "zu ein nicht sich auf dem el los las que de en un una con para por es se del le la les des et "
    "du pour dans est une sur au par ce"
).split()
SYMBOLS = "#$%&*|!^~<>{}[]\\/=_@"

STATISTICS = [
    "log_bytes", "log_words", "mean_word", "letters", "capitals", "digits", "spaces", "marks",
    "symbols", "high_bytes", "lines", "pipes", "exclamations", "capital_words", "symbol_words",
    "short_words", "long_words", "frequent_words", "distinct_words", "top_word", "repeated_pairs",
    "same_as_before", "words_a_line", "repeated_lines",
]


def _hash_of(words: list[str]) -> np.ndarray:
    data = np.frombuffer("".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w.encode()) for w in words])
    return run_hash(data, np.append(0, ends[:-1]), ends)


def _class_table() -> np.ndarray:
    """Bit of each byte: letter 1, capital 2, digit 4, space 8, mark 16, symbol 32, high 64."""
    table = np.zeros(256, np.uint8)
    table[[*range(97, 123)]] = 1
    table[[*range(65, 91)]] = 1 | 2
    table[48:58] = 4
    table[[9, 10, 11, 12, 13, 32]] = 8
    table[[ord(c) for c in ".,;:?'\"-()"]] = 16
    table[[ord(c) for c in SYMBOLS]] = 32
    table[128:] = 64
    return table


def _share_repeated(values: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per owner the number of distinct values and the count of the most frequent one."""
    order = np.lexsort((values, owner))
    v, o = values[order], owner[order]
    fresh = np.ones(len(v), bool)
    fresh[1:] = (v[1:] != v[:-1]) | (o[1:] != o[:-1])
    starts = np.flatnonzero(fresh)
    counts = np.diff(np.append(starts, len(v)))
    distinct = np.bincount(o[starts], minlength=n)
    most = np.zeros(n, np.int64)
    np.maximum.at(most, o[starts], counts)
    return distinct, most


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of STATISTICS for each text; zeros for an empty one."""
    n = len(offsets) - 1
    out = np.zeros((n, len(STATISTICS)))
    if not len(data):
        return out
    col = {name: i for i, name in enumerate(STATISTICS)}
    size = np.diff(offsets).astype(float)
    some = np.maximum(size, 1)
    kinds = _class_table()[data]

    def total(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return sums[offsets[1:]] - sums[offsets[:-1]]

    for name, bit in (("letters", 1), ("capitals", 2), ("digits", 4), ("spaces", 8),
                      ("marks", 16), ("symbols", 32), ("high_bytes", 64)):
        out[:, col[name]] = total((kinds & bit) > 0) / some
    lines = total(data == 10) + (size > 0)
    out[:, col["pipes"]] = total(data == 124) / some
    out[:, col["exclamations"]] = total(data == 33) / some
    starts, ends, owner = word_bounds(data, offsets)
    words = np.bincount(owner, minlength=n)
    per = np.maximum(words, 1)
    out[:, col["log_bytes"]] = np.log1p(size)
    out[:, col["log_words"]] = np.log1p(words)
    out[:, col["lines"]] = np.log1p(lines)
    out[:, col["words_a_line"]] = np.log1p(words / np.maximum(lines, 1))
    if not len(starts):
        return out
    length = ends - starts

    def share(flags: np.ndarray) -> np.ndarray:
        return np.bincount(owner, weights=flags, minlength=n) / per

    out[:, col["mean_word"]] = share(length) / 10
    capital_sums = np.concatenate([[0], np.cumsum((kinds & 2) > 0)])
    capitals = capital_sums[ends] - capital_sums[starts]
    out[:, col["capital_words"]] = share((capitals >= 2) & (2 * capitals >= length))
    out[:, col["symbol_words"]] = share((kinds[ends - 1] & 32) > 0)
    out[:, col["short_words"]] = share(length <= 2)
    out[:, col["long_words"]] = share(length >= 14)
    hashes = run_hash(lowered(data), starts, ends)
    out[:, col["frequent_words"]] = share(np.isin(hashes, _hash_of(FREQUENT_WORDS)))
    distinct, most = _share_repeated(hashes, owner, n)
    out[:, col["distinct_words"]] = distinct / per
    out[:, col["top_word"]] = most / per
    same_doc = owner[1:] == owner[:-1]
    pairs = hashes[1:][same_doc] * np.uint64(3) + hashes[:-1][same_doc]
    pair_owner = owner[1:][same_doc]
    n_pairs = np.maximum(np.bincount(pair_owner, minlength=n), 1)
    out[:, col["repeated_pairs"]] = 1 - _share_repeated(pairs, pair_owner, n)[0] / n_pairs
    out[:, col["repeated_pairs"]] *= words > 1
    again = (hashes[1:] == hashes[:-1]) & same_doc
    out[:, col["same_as_before"]] = np.bincount(owner[1:], weights=again, minlength=n) / per
    # A line is known by the words in it.
    line_no = np.concatenate([[0], np.cumsum(data == 10)])[starts] + owner
    edge = np.ones(len(starts), bool)
    edge[1:] = line_no[1:] != line_no[:-1]
    first = np.flatnonzero(edge)
    within = np.arange(len(hashes)) - np.repeat(first, np.diff(np.append(first, len(hashes))))
    line_hash = np.add.reduceat(hashes * (2 * within + 1).astype(np.uint64), first)
    line_owner = owner[first]
    n_lines = np.maximum(np.bincount(line_owner, minlength=n), 1)
    out[:, col["repeated_lines"]] = 1 - _share_repeated(line_hash, line_owner, n)[0] / n_lines
    out[:, col["repeated_lines"]] *= words > 0
    return out


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of each row's whole text; rows aren't moved."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for first, last in byte_slices(offsets):
                at = offsets[first : last + 1] - offsets[first]
                rows = statistics(data[offsets[first] : offsets[last]], at)
                values = pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), rows.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        values.cast(pa.list_(pa.float64())),
                    ],
                    ["doc_id", "statistics"],
                )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, statistics array<double>")


def _rows_of(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


class Fourier:
    """Scaling and random cosine features; the last feature is the intercept."""

    def __init__(self, mean: np.ndarray, deviation: np.ndarray) -> None:
        rng = np.random.default_rng(SEED)
        n = len(mean)
        self.mean, self.scale = mean, 1 / np.maximum(deviation, 1e-6)
        self.weights = rng.normal(size=(n, FEATURES)) / np.sqrt(n)
        self.phase = rng.uniform(0, 2 * np.pi, FEATURES)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) * self.scale, -8, 8)
        out = np.empty((len(x), FEATURES + 1))
        out[:, :FEATURES] = np.cos(z @ self.weights + self.phase) * np.sqrt(2 / FEATURES)
        out[:, FEATURES] = 1
        return out


def isotonic(total: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Non-decreasing rates of the steps by pooling neighbours that fall; empty steps lie between."""
    used = np.flatnonzero(total)
    blocks: list[list[float]] = []
    for k in used:
        blocks.append([float(ones[k]), float(total[k]), 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            o, t, m = blocks.pop()
            blocks[-1] = [blocks[-1][0] + o, blocks[-1][1] + t, blocks[-1][2] + m]
    rates = np.concatenate([[o / t] * m for o, t, m in blocks])
    return np.interp(np.arange(len(total)), used, rates)


class QualityModel:
    """A fitted score: features, ridge solution and calibration."""

    def __init__(self, features: Fourier | None, solution, low=0.0, high=1.0, rates=None) -> None:
        self.features, self.solution = features, solution
        self.low, self.high, self.rates = low, high, rates

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.solution

    def step(self, raw: np.ndarray) -> np.ndarray:
        part = (raw - self.low) / max(self.high - self.low, 1e-9)
        return np.clip(part * STEPS, 0, STEPS - 1).astype(np.int64)

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.features is None:
            return np.full(len(x), 0.5)
        return np.clip(self.rates[self.step(self.raw(x))], 0, 1)


def fit(labelled: DataFrame) -> QualityModel:
    """Fit on rows (statistics, quality 0 or 1). Without rows every score is 0.5.

    What leaves the executors has a fixed size: sums of the statistics, the normal equations (one
    row for each row of the matrix) and a histogram.
    """
    n = len(STATISTICS)
    moments = labelled.agg(
        F.count("*"),
        *[F.avg(F.get("statistics", F.lit(i))) for i in range(n)],
        *[F.stddev_pop(F.get("statistics", F.lit(i))) for i in range(n)],
    ).first()
    if not moments[0]:
        return QualityModel(None, None)
    features = Fourier(np.array(moments[1 : n + 1]), np.array(moments[n + 1 :]))

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FEATURES + 1, FEATURES + 2))
        for batch in batches:
            if batch.num_rows:
                z = features(_rows_of(batch.column(0)))
                total[:, :-1] += z.T @ z
                total[:, -1] += z.T @ batch.column(1).to_numpy().astype(float)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.arange(FEATURES + 1)),
                pa.FixedSizeListArray.from_arrays(
                    pa.array(total.ravel()), FEATURES + 2
                ).cast(pa.list_(pa.float64())),
            ],
            ["row", "sums"],
        )

    def add(table: pa.Table) -> pa.Table:
        sums = np.sum([r for r in table["sums"].to_pylist()], axis=0)
        return pa.table(
            {
                "row": pa.array([table["row"][0].as_py()], pa.int64()),
                "sums": pa.array([sums.tolist()], pa.list_(pa.float64())),
            }
        )

    schema = "row long, sums array<double>"
    rows = (
        labelled.select("statistics", "quality")
        .mapInArrow(equations, schema)
        .groupBy("row")
        .applyInArrow(add, schema)
        .collect()
    )
    system = np.array([r["sums"] for r in sorted(rows, key=lambda r: r["row"])])
    gram = system[:, :-1] + RIDGE * moments[0] * np.diag(np.append(np.ones(FEATURES), 0)) / FEATURES
    solution = np.linalg.lstsq(gram, system[:, -1], rcond=None)[0]
    model = QualityModel(features, solution)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(model.raw(_rows_of(batch.column(0)))), batch.column(1)],
                    ["raw", "quality"],
                )

    raw = labelled.select("statistics", F.col("quality").cast("long")).mapInArrow(
        scored, "raw double, quality long"
    )
    model.low, model.high = raw.agg(F.min("raw"), F.max("raw")).first()
    part = (F.col("raw") - model.low) / max(model.high - model.low, 1e-9) * STEPS
    steps = (
        raw.withColumn("step", F.greatest(F.least(F.floor(part), F.lit(STEPS - 1)), F.lit(0)))
        .groupBy("step")
        .agg(F.count("*").alias("n"), F.sum("quality").alias("ones"))
        .collect()
    )
    total, ones = np.zeros(STEPS), np.zeros(STEPS)
    for r in steps:
        total[r["step"]], ones[r["step"]] = r["n"], r["ones"]
    model.rates = isotonic(total, ones)
    return model


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score every row of ``docs`` (doc_id, text) by a model learnt from ``labels`` (doc_id, quality).

    Returns doc_id, held_out, score (0 to 1) and predicted (1 from CUT on). Labels of documents
    whose checksum has the held-out remainder aren't read; labels other than 0 and 1, and labels
    without a document, are left out; a document labelled twice counts twice. A null text is
    empty; a null doc_id is not held out and has no label. Every row gives a row, also those that
    repeat a doc_id, and equal texts have equal scores. A text of any length is measured whole. An
    empty table gives an empty result; other columns are ignored, whatever their names.
    """
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS
    counted = staged(document_statistics(docs), "statistics")
    known = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int")).filter(
        "quality IN (0, 1)"
    )
    learnt = staged(
        counted.filter(remainder != HELD_OUT).join(known.filter(remainder != HELD_OUT), "doc_id"),
        "labelled",
    )
    model = fit(learnt)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(model.score(_rows_of(batch.column(1))))],
                    ["doc_id", "score"],
                )

    return counted.mapInArrow(score, "doc_id long, score double").select(
        "doc_id",
        F.coalesce(remainder == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
    )
