"""Languages of words by a linear-chain conditional random field.

Each word is labelled with a language. Its features are hashed: all n-grams of two to four bytes
with the word's borders (those at a border are its affixes) and the word itself as an entry of a
lexicon; transitions between the languages of neighbouring words are learnt with them. Words of
code-switched text get their marginals by forward-backward, and a document's language is the one
with the most expected words.

The chain is cut into blocks of words; products of the blocks' transition matrices are formed for
all blocks at once and chained from block to block, so a long text takes few array steps.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemill.llm.shared import byte_slices, run_hash, ship, utf8
from casemill.session import staged

TABLE_BITS = 16
BLOCK_WORDS = 32
#: The training sample: about so many documents of each language, dealt to so many trainers.
SAMPLE_DOCUMENTS = 400
TRAINERS = 8
ROUNDS = 3
STEP = 0.3
DECAY = 1e-6
#: Words of a training sequence, each made of two stretches that may differ in language.
STRETCH_WORDS = 24
#: Sequences of one gradient step.
STEP_SEQUENCES = 128
FOLDS, HELD_OUT = 3, 1
UNKNOWN = "und"


def _letters() -> np.ndarray:
    """Each byte lowered if it may be part of a word (ASCII letters, bytes of others), else 0."""
    table = np.zeros(256, np.uint8)
    table[97:123] = np.arange(97, 123)
    table[65:91] = np.arange(97, 123)
    table[128:] = np.arange(128, 256)
    return table


def word_features(data: np.ndarray, offsets: np.ndarray):
    """Hashed features of the words of all texts: four columns of table places for each byte of a
    word, where each word's places begin, and the words' texts."""
    letters = _letters()[data]
    inside = letters > 0
    starts_of = inside.copy()
    starts_of[1:] &= ~inside[:-1]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    starts_of[edges] = inside[edges]
    starts = np.flatnonzero(starts_of)
    owner = np.searchsorted(offsets, starts, "right") - 1
    # The words one after another, a 1 before each and one at the end.
    n_bytes = int(inside.sum())
    line = np.ones(n_bytes + len(starts) + 1, np.uint8)
    number = np.cumsum(starts_of)[inside]
    line[np.arange(n_bytes) + number] = letters[inside]
    begins = np.flatnonzero(line[:-1] == 1)
    wide = line.astype(np.uint32)
    n = len(line) - 1
    wide = np.concatenate([wide, np.ones(3, np.uint32)])
    mask = np.uint32((1 << TABLE_BITS) - 1)
    border = wide == 1

    def place(grams: np.ndarray, salt: int, bad: np.ndarray) -> np.ndarray:
        h = (grams + np.uint32(salt)) * np.uint32(2654435761)
        h = (h >> np.uint32(32 - TABLE_BITS)) & mask
        return np.where(bad, 0, np.maximum(h, 1)).astype(np.int32)

    two = wide[:n] << np.uint32(8) | wide[1 : n + 1]
    three = two << np.uint32(8) | wide[2 : n + 2]
    four = three << np.uint32(8) | wide[3 : n + 3]
    columns = np.zeros((n, 4), np.int32)
    if n:
        columns[:, 0] = place(two, 1, np.zeros(n, bool))
        bad = border[1 : n + 1]
        columns[:, 1] = place(three, 2, bad)
        bad = bad | border[2 : n + 2]
        columns[:, 2] = place(four, 3, bad)
    if len(starts):
        ends = np.append(begins[1:], n)
        whole = run_hash(line, begins + 1, ends)
        columns[begins, 3] = ((whole >> np.uint64(20)).astype(np.uint32) & mask).astype(np.int32)
    return columns, begins, owner


def emissions(weights: np.ndarray, columns: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Score of each language for each word."""
    if not len(begins):
        return np.zeros((0, weights.shape[1]))
    total = weights[columns[:, 0]]
    for k in (1, 2):
        total += weights[columns[:, k]]
    out = np.add.reduceat(total, begins, axis=0)
    return (out + weights[columns[begins, 3]]).astype(np.float64)


def marginals(scores: np.ndarray, counts: np.ndarray, turn: np.ndarray, first: np.ndarray):
    """Forward-backward over chains of ``counts`` words standing one after another.

    ``turn`` and ``first`` are the scores of transitions and of the first language. Returns the
    marginals of the words, and the normed forward and backward vectors.
    """
    n, labels = scores.shape
    counts = counts[counts > 0]
    chain_start = np.cumsum(counts) - counts
    emit = np.exp(scores - scores.max(axis=1, keepdims=True)) + 1e-30
    step = np.exp(turn - turn.max())
    begin = np.exp(first - first.max())
    blocks = -(-counts // BLOCK_WORDS)
    chain = np.repeat(np.arange(len(counts)), blocks)
    nth = np.arange(len(chain)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    start = chain_start[chain] + nth * BLOCK_WORDS
    size = np.minimum(BLOCK_WORDS, counts[chain] - nth * BLOCK_WORDS)

    def normed(x: np.ndarray) -> np.ndarray:
        return x / x.sum(axis=-1, keepdims=True)

    product = np.broadcast_to(np.eye(labels), (len(chain), labels, labels)).copy()
    for t in range(BLOCK_WORDS):
        on = np.flatnonzero(t < size)
        if not len(on):
            break
        p = np.matmul(product[on], step) * emit[start[on] + t][:, None, :]
        product[on] = p / p.max(axis=(1, 2), keepdims=True)
    into = np.zeros((len(chain), labels))  # forward vector before a block
    after = np.ones((len(chain), labels))  # backward vector at the end of a block
    block_start = np.cumsum(blocks) - blocks
    most = int(blocks.max()) if len(blocks) else 0
    forward = np.zeros((n, labels))
    forward[chain_start] = normed(begin[None, :] * emit[chain_start])
    first_block = np.zeros(len(chain), bool)
    first_block[block_start] = True
    for t in range(1, BLOCK_WORDS):
        on = block_start[t < size[block_start]]
        at = start[on] + t
        forward[at] = normed((forward[at - 1] @ step) * emit[at])
    vector = forward[start[block_start] + size[block_start] - 1]
    for k in range(1, most):
        on = np.flatnonzero(blocks > k)
        b = block_start[on] + k
        into[b] = vector[on]
        vector[on] = normed(np.matmul(vector[on][:, None, :], product[b])[:, 0, :])
    for t in range(BLOCK_WORDS):
        on = np.flatnonzero((t < size) & ~first_block)
        if not len(on):
            break
        at = start[on] + t
        before = into[on] if t == 0 else forward[at - 1]
        forward[at] = normed((before @ step) * emit[at])
    for k in range(most - 2, -1, -1):
        on = np.flatnonzero(blocks > k + 1)
        b = block_start[on] + k
        after[b] = normed(np.matmul(product[b + 1], after[b + 1][:, :, None])[:, :, 0])
    backward = np.zeros((n, labels))
    for t in range(BLOCK_WORDS - 1, -1, -1):
        on = np.flatnonzero(t < size)
        at = start[on] + t
        last = t == size[on] - 1
        backward[at[last]] = after[on[last]]
        rest = at[~last]
        backward[rest] = normed((backward[rest + 1] * emit[rest + 1]) @ step.T)
    return normed(forward * backward + 1e-300), forward, backward, emit, step


class Field:
    """Weights of a fitted field for a list of languages."""

    def __init__(self, languages: list[str]) -> None:
        n = len(languages)
        self.languages = languages
        self.weights = np.zeros((1 << TABLE_BITS, n), np.float32)
        self.turn = np.eye(n) * 1.0
        self.first = np.zeros(n)

    def words(self, data: np.ndarray, offsets: np.ndarray):
        """Marginals and owners of the words of all texts."""
        columns, begins, owner = word_features(data, offsets)
        scores = emissions(self.weights, columns, begins)
        if not len(scores):
            return scores, owner
        counts = np.bincount(owner, minlength=len(offsets) - 1)
        return marginals(scores, counts, self.turn, self.first)[0], owner

    def documents(self, data: np.ndarray, offsets: np.ndarray):
        """Share of the words of each text in each language; zeros without words."""
        n = len(offsets) - 1
        share, owner = self.words(data, offsets)
        total = np.zeros((n, len(self.languages)))
        for k in range(len(self.languages)):
            total[:, k] = np.bincount(owner, weights=share[:, k], minlength=n) if len(owner) else 0
        return total / np.maximum(np.bincount(owner, minlength=n), 1)[:, None]


def _sequences(texts: pa.Array, labels: np.ndarray, rng: np.random.Generator):
    """Features of all words, and chains of two stretches of words, each of one document."""
    data, offsets = utf8(texts)
    columns, begins, owner = word_features(data, offsets)
    ends = np.append(begins[1:], len(columns))
    counts = np.bincount(owner, minlength=len(offsets) - 1)
    stretches = []
    for d, (first, n) in enumerate(zip(np.cumsum(counts) - counts, counts, strict=True)):
        stretches += [
            (first + i, min(first + i + STRETCH_WORDS, first + n), labels[d])
            for i in range(0, n, STRETCH_WORDS)
        ]
    order = rng.permutation(len(stretches))
    return columns, begins, ends, [stretches[i] for i in order]


def _train(field: Field, texts: pa.Array, labels: np.ndarray, seed: int) -> Field:
    """One pass of adaptive gradient steps over the sequences of some documents."""
    rng = np.random.default_rng(seed)
    columns, begins, ends, stretches = _sequences(texts, labels, rng)
    n_labels = len(field.languages)
    squares = np.full(field.weights.shape, 0.1, np.float32)
    turn_squares = np.full(field.turn.shape, 1.0)
    first_squares = np.full(field.first.shape, 1.0)
    for at in range(0, len(stretches), 2 * STEP_SEQUENCES):
        part = stretches[at : at + 2 * STEP_SEQUENCES]
        words = np.concatenate([np.arange(s, e) for s, e, _ in part])
        truth = np.concatenate([np.full(e - s, y) for s, e, y in part])
        counts = np.array(
            [sum(e - s for s, e, _ in part[i : i + 2]) for i in range(0, len(part), 2)]
        )
        length = ends[words] - begins[words]
        rows = np.repeat(begins[words], length) + np.arange(int(length.sum())) - np.repeat(
            np.cumsum(length) - length, length
        )
        local = columns[rows]
        local_begins = np.cumsum(length) - length
        scores = emissions(field.weights, local, local_begins)
        share, forward, backward, emit, step = marginals(scores, counts, field.turn, field.first)
        error = share.copy()
        error[np.arange(len(words)), truth] -= 1
        error /= len(counts)
        owner = np.repeat(np.arange(len(words)), length)
        places = np.concatenate([local[:, 0], local[:, 1], local[:, 2], local[local_begins, 3]])
        owners = np.concatenate([owner, owner, owner, np.arange(len(words))])
        for k in range(n_labels):
            g = np.bincount(places, weights=error[owners, k], minlength=len(field.weights))
            g[0] = 0
            g += DECAY * field.weights[:, k]
            squares[:, k] += g * g
            field.weights[:, k] -= STEP * g / np.sqrt(squares[:, k])
        chain_start = np.cumsum(counts) - counts
        inner = np.ones(len(words), bool)
        inner[chain_start] = False
        now = np.flatnonzero(inner)
        both = forward[now - 1][:, :, None] * step * (emit[now] * backward[now])[:, None, :]
        both /= both.sum(axis=(1, 2), keepdims=True)
        expected = both.sum(axis=0)
        np.subtract.at(expected, (truth[now - 1], truth[now]), 1)
        expected /= len(counts)
        turn_squares += expected**2
        field.turn -= STEP * expected / np.sqrt(turn_squares)
        begun = share[chain_start].sum(axis=0) - np.bincount(
            truth[chain_start], minlength=n_labels
        )
        begun /= len(counts)
        first_squares += begun**2
        field.first -= STEP * begun / np.sqrt(first_squares)
    return field


def fit(docs: DataFrame) -> Field | None:
    """Fit on ``docs`` (text, lang), of which a sample of bounded size is used; None without any.

    Each round every trainer makes one pass over its part of the sample from the same weights, and
    the driver averages the trainers' weights, which have a fixed size.
    """
    counts = {r["lang"]: r["n"] for r in docs.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    languages = sorted(counts)
    draw = F.pmod(F.xxhash64(F.lit(3), "doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    rate = F.coalesce(
        *[F.when(F.col("lang") == k, F.lit(min(1.0, SAMPLE_DOCUMENTS / counts[k]))) for k in languages]
    )
    number = F.coalesce(*[F.when(F.col("lang") == k, F.lit(i)) for i, k in enumerate(languages)])
    sample = staged(
        docs.filter(draw < rate)
        .select(
            "text", number.alias("label"), F.xxhash64(F.lit(4), "doc_id", "text").alias("draw")
        )
        .withColumn("trainer", F.pmod("draw", F.lit(TRAINERS)))
        .repartition(TRAINERS, "trainer"),
        "language-sample",
    )
    field = Field(languages)
    for turn in range(ROUNDS):
        field = _average(sample, field, turn)
    return field


def _average(sample: DataFrame, field: Field, turn: int) -> Field:
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("draw").combine_chunks()
        trained = Field(field.languages)
        trained.weights = field.weights.copy()
        trained.turn, trained.first = field.turn.copy(), field.first.copy()
        text = table["text"]
        text = pa.concat_arrays(text.chunks) if isinstance(text, pa.ChunkedArray) else text
        _train(trained, text, table["label"].to_numpy(), 100 * turn + 7)
        raw = trained.weights.tobytes() + trained.turn.tobytes() + trained.first.tobytes()
        return pa.table({"raw": pa.array([raw], pa.binary())})

    rows = sample.groupBy("trainer").applyInArrow(run, "raw binary").collect()
    out = Field(field.languages)
    a, b = field.weights.nbytes, field.weights.nbytes + field.turn.nbytes
    shape = field.weights.shape

    def mean(kind, first, last) -> np.ndarray:
        return np.mean([np.frombuffer(r["raw"][first:last], kind) for r in rows], axis=0)

    if rows:
        out.weights = mean(np.float32, 0, a).reshape(shape).astype(np.float32)
        out.turn = mean(np.float64, a, b).reshape(field.turn.shape)
        out.first = mean(np.float64, b, None)
    return out


def predict(docs: DataFrame, field: Field | None) -> DataFrame:
    """doc_id, lang_pred and score (its expected share of the words) of each row's whole text."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for first, last in byte_slices(offsets):
                at = offsets[first : last + 1] - offsets[first]
                names, scores = _predict_slice(
                    field, data[offsets[first] : offsets[last]], at, batch.column(1), first
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        pa.array(names, pa.string()),
                        pa.array(scores, pa.float64()),
                    ],
                    ["doc_id", "lang_pred", "score"],
                )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def accepted(docs: DataFrame, field: Field | None, least: float) -> DataFrame:
    """The rows of ``docs`` whose language is known with a score of ``least`` or more.

    All columns stay as they are, whatever their names, and rows aren't moved; a null text goes, an
    empty table stays empty.
    """
    ship(docs.sparkSession)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(at))
            keep = [np.zeros(0, bool)]
            for first, last in byte_slices(offsets):
                part = offsets[first : last + 1] - offsets[first]
                names, scores = _predict_slice(
                    field, data[offsets[first] : offsets[last]], part, batch.column(at), first
                )
                keep.append((np.array(names) != UNKNOWN) & (np.array(scores) >= least))
            yield batch.filter(pa.array(np.concatenate(keep)))

    return docs.mapInArrow(run, docs.schema)


def _predict_slice(field, data, offsets, texts, first):
    n = len(offsets) - 1
    if field is None:
        return [UNKNOWN] * n, [0.0] * n
    share = field.documents(data, offsets)
    best = share.argmax(axis=1)
    ascii_letters = np.concatenate([[0], np.cumsum((data | 32) - np.uint8(97) < 26)])
    plain = ascii_letters[offsets[1:]] > ascii_letters[offsets[:-1]]
    names, scores = [], []
    for i in range(n):
        known = plain[i] or any(c.isalpha() for c in texts[first + i].as_py() or "")
        names.append(field.languages[best[i]] if known else UNKNOWN)
        scores.append(float(min(1.0, share[i, best[i]])) if known else 0.0)
    return names, scores


def _remainder():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS


def learnt_field(docs: DataFrame) -> Field | None:
    """The field learnt from the rows of ``docs`` (doc_id, text, lang) that aren't held out."""
    ship(docs.sparkSession)
    usable = docs.select(
        F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string")
    ).filter("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL")
    return fit(usable.filter(_remainder() != HELD_OUT))


def languages(docs: DataFrame) -> DataFrame:
    """The language of every row's whole text.

    Returns doc_id, held_out, lang_pred and score. Learns from rows with a language whose checksum
    hasn't the held-out remainder; a null doc_id is neither held out nor learnt from. A text that
    is null or has no letter, or any text if there is nothing to learn from, is UNKNOWN with score
    0. Words are runs of ASCII letters and bytes of other characters. Languages that tie share the
    first place of their names' order. Every row gives a row, also those that repeat a doc_id; a
    text of any length counts with all its words. An empty table gives an empty result; other
    columns are ignored, whatever their names.
    """
    return predict(docs, learnt_field(docs)).select(
        "doc_id",
        F.coalesce(_remainder() == HELD_OUT, F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
    )
