"""N-gram Jaccard join: an LSH forest of MinHash signatures, then exact verification.

Equal word sequences are one text. Every text gets ``TREES`` x ``DEPTH`` minimum hashes of its
word shingles; the values of a tree, in order, are a path of that tree's prefix trie. Texts that
share a prefix of a tree are candidates. The prefix starts at full length and is shortened until
both the recall that theory gives at the threshold and the recall measured by an audit (some
texts against all others, by their whole signatures) reach the target.

Within a prefix, pairs are looked at by their whole signatures and only the edges that hold their
components together go on. Each candidate component is then verified exactly, in blocks, so that
every link between two different texts is found and counted, while no list of all pairs is made.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casemill.llm.components import components, spanning
from casemill.llm.shared import (
    WORD_BASE,
    byte_slices,
    free_name,
    mix,
    shingle_hashes,
    ship,
    utf8,
    word_hashes,
)
from casemill.session import staged

WIDTH = 5
THRESHOLD = 0.8
TREES = 20
DEPTH = 5
TARGET_RECALL = 0.9999
#: Texts whose similar texts are counted by comparing them with all others' signatures.
AUDIT_TEXTS = 256
#: Pairs whose signatures agree in less than the threshold less this (five deviations) part.
SLACK = 0.2
#: Rows with one prefix that are compared with each other; larger buckets are one component.
BUCKET_ROWS = 1_024
#: Texts of a component verified together; larger components are verified block by block.
BLOCK_TEXTS = 256
#: Texts of small components that share a task's group.
UNIT_TEXTS = 512

SIGNATURE_SCHEMA = "doc_id long, h1 long, h2 long, n_shingles long, signature binary"
VERIFIED_SCHEMA = "a long, b long, links long"


def _hash_family(n: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * WORD_BASE)
    return seeds[:n] | np.uint64(1), seeds[n:]


def _runs(owner: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    fresh = np.ones(len(owner), bool)
    fresh[1:] = owner[1:] != owner[:-1]
    return np.flatnonzero(fresh)


def signatures(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Two hashes of the word sequence and the minimum hashes of each row's whole text.

    A text without words has hashes 0 and no signature. Rows aren't moved.
    """
    ship(docs.sparkSession)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factor, shift = _hash_family(TREES * DEPTH)
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for first, last in byte_slices(offsets):
                n = last - first
                at = offsets[first : last + 1] - offsets[first]
                hashes, docs_of = word_hashes(data[offsets[first] : offsets[last]], at)
                h1, h2 = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
                made = np.zeros(n, np.int64)
                signature = np.zeros((n, TREES * DEPTH), np.uint32)
                if len(hashes):
                    counts = np.bincount(docs_of, minlength=n)
                    place = np.arange(len(hashes)) - (np.cumsum(counts) - counts)[docs_of]
                    turn = mix(place.astype(np.uint64) * WORD_BASE + np.uint64(7))
                    starts = _runs(docs_of)
                    with_words = docs_of[starts]
                    h1[with_words] = np.add.reduceat(mix(hashes ^ turn), starts)
                    h2[with_words] = np.add.reduceat(mix(hashes + np.uint64(3) * turn), starts)
                    shingles, owner = shingle_hashes(hashes, docs_of, n, width)
                    starts = _runs(owner)
                    made[owner[starts]] = np.diff(np.append(starts, len(owner)))
                    for k in range(TREES * DEPTH):
                        least = np.minimum.reduceat(shingles * factor[k] + shift[k], starts)
                        signature[owner[starts], k] = (least >> np.uint64(32)).astype(np.uint32)
                rows = [
                    s.tobytes() if m else None for s, m in zip(signature, made, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, n),
                        pa.array(h1.view(np.int64)),
                        pa.array(h2.view(np.int64)),
                        pa.array(made),
                        pa.array(rows, pa.binary()),
                    ],
                    ["doc_id", "h1", "h2", "n_shingles", "signature"],
                )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(sign, SIGNATURE_SCHEMA)


def _matrix(column: pa.Array, kind, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), width)


def recall_at(depth: int, similarity: float, trees: int = TREES) -> float:
    """Chance that a pair shares a prefix of this length in some tree."""
    return 1 - (1 - similarity**depth) ** trees


def audit(texts: DataFrame, threshold: float) -> dict[int, int]:
    """Pairs of an audited and any other text, similar by signature, by longest shared prefix.

    The audited texts are those with the smallest hashes of their ids, a fixed number of them.
    """
    chosen = texts.orderBy(F.xxhash64("rep"), "rep").limit(AUDIT_TEXTS).collect()
    if not chosen:
        return {}
    ids = np.array([r["rep"] for r in chosen], np.int64)
    probes = np.frombuffer(b"".join(r["signature"] for r in chosen), np.uint32)
    probes = probes.reshape(len(chosen), TREES * DEPTH)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(DEPTH + 1, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            all_ids = batch.column(0).to_numpy()
            all_rows = _matrix(batch.column(1), np.uint32, TREES * DEPTH)
            for i, probe in zip(ids, probes, strict=True):
                same = all_rows == probe
                near = (same.mean(axis=1) >= threshold) & (all_ids != i)
                if near.any():
                    trees = same[near].reshape(-1, TREES, DEPTH)
                    shared = np.cumprod(trees, axis=2).sum(axis=2).max(axis=1)
                    found += np.bincount(shared, minlength=DEPTH + 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(DEPTH + 1)), pa.array(found)], ["depth", "pairs"]
        )

    rows = texts.select("rep", "signature").mapInArrow(compare, "depth long, pairs long")
    return {r["depth"]: r["n"] for r in rows.groupBy("depth").agg(F.sum("pairs").alias("n")).collect()}


def choose_depth(found: dict[int, int], threshold: float, target: float) -> int:
    """The longest prefix that reaches the target recall in theory and in the audit."""
    total = sum(found.values())
    for depth in range(DEPTH, 0, -1):
        caught = sum(n for d, n in found.items() if d >= depth)
        if recall_at(depth, threshold) >= target and caught >= target * total:
            return depth
    return 1


def candidate_edges(texts: DataFrame, depth: int, threshold: float) -> DataFrame:
    """Edges that hold together all pairs which share a prefix and may reach the threshold."""

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _matrix(batch.column(1), np.uint32, TREES * DEPTH)
            rows = rows.reshape(-1, TREES, DEPTH).astype(np.uint64)
            key = np.arange(1, TREES + 1, dtype=np.uint64) * WORD_BASE
            key = np.broadcast_to(key, rows.shape[:2]).copy()
            for d in range(depth):
                key = mix((key ^ rows[:, :, d]) * WORD_BASE + np.uint64(d))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key.ravel().view(np.int64)),
                    pa.array(np.repeat(batch.column(0).to_numpy(), TREES)),
                ],
                ["key", "rep"],
            )

    keys = texts.select("rep", "signature").mapInArrow(prefixes, "key long, rep long")
    shared = (
        keys.withColumn("members", F.count("*").over(Window.partitionBy("key")))
        .filter("members > 1")
        .select("key", "rep")
    )
    rows = (
        shared.join(texts.select("rep", "signature"), "rep")
        .repartition("key")
        .sortWithinPartitions("key", "rep")
        .select("key", "rep", "signature")
    )
    least = threshold - SLACK

    def connect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, reps, sigs in _whole_buckets(batches):
            a, b = _bucket_edges(keys, reps, sigs, least)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return rows.mapInArrow(connect, "a long, b long").distinct()


def _whole_buckets(batches: Iterator[pa.RecordBatch]):
    """Sorted rows in parts that end where a key ends; only the low byte of each value is kept.

    Of a bucket too large for comparisons only the ids of its first row and of the new rows are
    needed, so what waits for the next batch stays bounded.
    """
    waiting = None
    for batch in batches:
        if not batch.num_rows:
            continue
        sigs = _matrix(batch.column(2), np.uint32, TREES * DEPTH).astype(np.uint8)
        part = (batch.column(0).to_numpy(), batch.column(1).to_numpy(), sigs)
        if waiting is not None:
            part = tuple(np.concatenate(x) for x in zip(waiting, part, strict=True))
        cut = int(np.searchsorted(part[0], part[0][-1]))
        if cut:
            yield tuple(x[:cut] for x in part)
        waiting = tuple(x[cut:] for x in part)
        if len(waiting[0]) > 4 * BUCKET_ROWS:
            yield waiting
            waiting = tuple(x[: BUCKET_ROWS + 1] for x in waiting)
    if waiting is not None:
        yield waiting


def _bucket_edges(keys, reps, sigs, least):
    starts = np.append(_runs(keys), len(keys))
    sizes = np.diff(starts)
    out_a, out_b = [], []
    pairs = starts[:-1][sizes == 2]
    if len(pairs):
        near = (sigs[pairs] == sigs[pairs + 1]).mean(axis=1) >= least
        out_a.append(reps[pairs[near]])
        out_b.append(reps[pairs[near] + 1])
    for start, size in zip(starts[:-1][sizes > 2], sizes[sizes > 2], strict=True):
        ids = reps[start : start + size]
        if size > BUCKET_ROWS:
            out_a.append(np.full(size - 1, ids[0]))
            out_b.append(ids[1:])
            continue
        rows = sigs[start : start + size]
        near = np.zeros((size, size), bool)
        for i in range(size - 1):
            near[i, i + 1 :] = (rows[i] == rows[i + 1 :]).mean(axis=1) >= least
        label = spanning(near | near.T)
        other = label != np.arange(size)
        out_a.append(ids[label[other]])
        out_b.append(ids[other])
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *out_a]), np.concatenate([empty, *out_b])


def _verify_block(sets, ids, blocks, cross, ratio):
    """Links of each text of a component (or of two of its blocks) and edges that span them."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    values = np.concatenate(sets)
    member = np.repeat(np.arange(n), sizes)
    order = np.argsort(values, kind="stable")
    values, member = values[order], member[order]
    starts = np.append(_runs(values), len(values))
    counts = np.diff(starts)
    shared = counts > 1
    column = np.repeat(np.cumsum(shared) - 1, counts)
    keep = np.repeat(shared, counts)
    column, member = column[keep], member[keep]
    common = np.zeros((n, n), np.int64)
    width = 4096
    for first in range(0, int(shared.sum()), width):
        lo, hi = np.searchsorted(column, [first, first + width])
        matrix = np.zeros((n, width), np.float32)
        matrix[member[lo:hi], column[lo:hi] - first] = 1
        common += (matrix @ matrix.T).astype(np.int64)
    union = sizes[:, None] + sizes[None, :] - common
    linked = common * ratio.denominator >= union * ratio.numerator
    np.fill_diagonal(linked, False)
    if cross:
        linked &= blocks[:, None] != blocks[None, :]
    label = spanning(linked)
    other = label != np.arange(n)
    return linked.sum(axis=1), ids[other], ids[label[other]]


def verified_links(
    docs: DataFrame, members: DataFrame, width: int, threshold: float
) -> DataFrame:
    """Exact links within candidate components (rep, component): a row (a, null, links) for the
    links of a text in one block pair, and rows (a, b, 0) for edges that span the linked texts."""
    ratio = Fraction(threshold).limit_denominator(10_000)
    sizes = members.groupBy("component").agg(F.count("*").alias("texts"))
    n_units = -(-members.count() // UNIT_TEXTS) or 1
    blocks = F.ceil(F.col("texts") / BLOCK_TEXTS).cast("long")
    dealt = (
        members.join(sizes, "component")
        .withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("rep"), "blocks"))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .withColumn(
            "unit",
            F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("component"), F.lit(n_units)))
            .otherwise(F.xxhash64("component", "low", "high")),
        )
    )
    rows = dealt.select("unit", "component", "low", "high", "block", "rep").join(
        # The same join at every size: the candidates grow with the texts.
        docs.select(
            F.col("doc_id").cast("long").alias("rep"), F.col("text").cast("string")
        ).hint("merge"),
        "rep",
    )

    def verify(table: pa.Table) -> pa.Table:
        table = table.sort_by(
            [("component", "ascending"), ("low", "ascending"), ("high", "ascending"),
             ("rep", "ascending"), ("text", "ascending")]
        ).combine_chunks()
        names = ["component", "low", "high", "rep", "block"]
        component, low, high, rep, block = (table[c].to_numpy() for c in names)
        text = pc.fill_null(table["text"], "").combine_chunks()
        if isinstance(text, pa.ChunkedArray):
            text = pa.concat_arrays(text.chunks) if text.num_chunks else pa.array([], pa.string())
        again = np.zeros(len(rep), bool)  # rows that repeat a doc_id
        again[1:] = (
            (rep[1:] == rep[:-1]) & (component[1:] == component[:-1])
            & (low[1:] == low[:-1]) & (high[1:] == high[:-1])
        )
        sets = []
        data, offsets = utf8(text)
        for first, last in byte_slices(offsets):
            at = offsets[first : last + 1] - offsets[first]
            hashes, owner = word_hashes(data[offsets[first] : offsets[last]], at)
            shingles, owner = shingle_hashes(hashes, owner, last - first, width)
            sets += np.split(shingles, np.searchsorted(owner, np.arange(1, last - first)))
        group = np.ones(len(rep), bool)
        group[1:] = (
            (component[1:] != component[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
        )
        bounds = np.append(np.flatnonzero(group), len(rep))
        out_a, out_b, out_links = [], [], []
        for s, e in zip(bounds[:-1], bounds[1:], strict=True):
            own = [i for i in range(s, e) if not again[i] and len(sets[i])]
            if len(own) < 2:
                continue
            links, a, b = _verify_block(
                [sets[i] for i in own], rep[own], block[own], low[s] != high[s], ratio
            )
            some = links > 0
            out_a += [rep[own][some], a]
            out_b += [np.full(int(some.sum()), -1), b]
            out_links += [links[some], np.zeros(len(a), np.int64)]
        empty = [np.zeros(0, np.int64)]
        b = np.concatenate(empty + out_b)
        links = np.concatenate(empty + out_links)
        return pa.table(
            {
                "a": pa.array(np.concatenate(empty + out_a), pa.int64()),
                "b": pa.array(b, pa.int64(), mask=links > 0),
                "links": pa.array(links, pa.int64()),
            }
        )

    return rows.groupBy("unit").applyInArrow(verify, VERIFIED_SCHEMA)


def near_duplicates(
    docs: DataFrame,
    width: int = WIDTH,
    threshold: float = THRESHOLD,
    target: float = TARGET_RECALL,
) -> DataFrame:
    """Near duplicates of ``docs`` (doc_id, text) by Jaccard similarity of word shingles.

    Returns a row per input row: doc_id, class_id (smallest doc_id reachable by links or equal
    text), text_id (smallest doc_id of the same word sequence), n_links (different texts linked
    directly) and kept (doc_id = class_id). Words are split at ASCII white space, ASCII letter
    case is ignored; a text of fewer than ``width`` words is one shingle. A text without words, or
    a row without doc_id, links with nothing and is kept. Rows that repeat a doc_id are one
    document; its smallest text is compared. A similarity of exactly ``threshold`` links (it is
    compared as a fraction). Texts of any length are compared whole. An empty table gives an empty
    result; other columns are ignored, whatever their names.
    """
    signed = staged(signatures(docs, width), "signatures")
    usable = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    texts = staged(
        usable.groupBy("h1", "h2").agg(
            F.min("doc_id").alias("rep"), F.max("signature").alias("signature")
        ),
        "texts",
    )
    depth = choose_depth(audit(texts, threshold), threshold, target)
    edges = candidate_edges(texts, depth, threshold)
    members = staged(
        components(edges).select(F.col("node").alias("rep"), "component"), "members"
    )
    checked = staged(verified_links(docs, members, width, threshold), "verified")
    links = checked.filter("b IS NULL").groupBy("a").agg(F.sum("links").alias("n_links"))
    linked = components(checked.filter("b IS NOT NULL").select("a", "b"))
    found = linked.join(links, linked.node == links.a, "left").select(
        F.col("node").alias("rep"), F.col("component").alias("class_id"), "n_links"
    )
    by_text = texts.select("h1", "h2", "rep").join(found, "rep", "left")
    words = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    return (
        signed.select("doc_id", "h1", "h2", "n_shingles")
        .join(by_text, ["h1", "h2"], "left")
        .select(
            "doc_id",
            F.when(words, F.coalesce("class_id", "rep")).otherwise(F.col("doc_id")).alias("class_id"),
            F.when(words, F.col("rep")).otherwise(F.col("doc_id")).alias("text_id"),
            F.when(words, F.coalesce("n_links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id")))
    )


def without_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each group of near duplicates, the one of smallest doc_id.

    Rows that repeat a doc_id are one document, of which the smallest text stays; rows without
    doc_id stay all. The columns stay as they are, whatever their names; an empty table stays empty.
    """
    kept_id, row = free_name(docs, "kept_id"), free_name(docs, "kept_row")
    kept = (
        near_duplicates(docs, **options)
        .filter("kept AND doc_id IS NOT NULL")
        .select(F.col("doc_id").alias(kept_id))
        .distinct()
    )
    first = Window.partitionBy("doc_id").orderBy("text")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows = (
        docs.filter("doc_id IS NOT NULL")
        .join(kept, F.col("doc_id").cast("long") == F.col(kept_id), "left_semi")
        .withColumn(row, F.row_number().over(first))
        .filter(F.col(row) == 1)
        .select(*columns)
    )
    return rows.unionByName(docs.filter("doc_id IS NULL"))
