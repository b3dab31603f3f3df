"""Quality and language: the mathematics against plain versions, and held-out accuracy."""

from __future__ import annotations

import itertools
import zlib

import numpy as np
import pytest

from casemill.llm import language, quality
from casemill.llm.language import Field, fit, languages, learnt_field, marginals
from casemill.llm.quality import STATISTICS, document_statistics, isotonic, quality_scores, statistics
from tests.llm.helpers import awkward_rows, frame, row, with_clashing_columns, words

SF = "/root/testdata/sf0.01"


def test_isotonic_pools_falling_rates():
    total = np.array([2, 0, 2, 4, 0, 1])
    ones = np.array([1, 0, 2, 1, 0, 1])
    out = isotonic(total, ones)
    assert (np.diff(out) >= 0).all()
    assert out[[0, 2, 3, 5]] == pytest.approx([0.5, 0.5, 0.5, 1.0])


def test_statistics_of_a_text():
    raw = "THE the der xx*** a|b\nTHE the der xx*** a|b".encode()
    out = dict(zip(STATISTICS, statistics(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0], strict=True))
    assert out["symbol_words"] == pytest.approx(2 / 10)
    assert out["frequent_words"] == pytest.approx(6 / 10)
    assert out["capital_words"] == pytest.approx(2 / 10)
    assert out["top_word"] == pytest.approx(4 / 10)
    assert out["repeated_lines"] == pytest.approx(1 / 2)
    assert out["same_as_before"] == pytest.approx(2 / 10)


def test_statistics_dont_depend_on_the_batch(spark):
    rows = awkward_rows()
    out = document_statistics(frame(spark, rows)).collect()
    for r in out:
        if r.doc_id is None or r.doc_id == 16:
            continue
        raw = (next(x[1] for x in rows if x[0] == r.doc_id) or "").encode()
        alone = statistics(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0]
        assert r.statistics == pytest.approx(list(alone))


def test_quality_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    out = quality_scores(docs, labels).join(labels, "doc_id").collect()
    for r in out:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [r for r in out if r.held_out]
    assert sum(r.predicted == r.quality for r in held) >= 0.93 * len(held)


def test_quality_of_awkward_rows(spark):
    rows = awkward_rows()
    labels = [(r[0], i % 2 if i % 5 else None, 0) for i, r in enumerate(rows)] + [(999, 1, 0), (1, 7, 0)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert quality_scores(with_clashing_columns(frame(spark)), labels).count() == len(rows)
    none = labels.filter("doc_id < 0")
    out = quality_scores(frame(spark), none).collect()
    assert {r.score for r in out} == {0.5}
    assert quality_scores(frame(spark, []), labels).count() == 0


def test_forward_backward_against_all_paths():
    rng = np.random.default_rng(1)
    turn, first = rng.normal(size=(3, 3)), rng.normal(size=3)
    counts = np.array([1, 4, 0, 6])
    scores = rng.normal(size=(11, 3)) * 2
    for block in (1, 2, 3, 32):
        language.BLOCK_WORDS = block
        got = marginals(scores, counts, turn, first)[0]
        at = 0
        for n in counts:
            want = np.zeros((n, 3))
            for path in itertools.product(range(3), repeat=int(n)):
                if not n:
                    continue
                s = first[path[0]] + sum(scores[at + i, y] for i, y in enumerate(path))
                s += sum(turn[a, b] for a, b in zip(path, path[1:]))
                for i, y in enumerate(path):
                    want[i, y] += np.exp(s)
            if n:
                want /= want.sum(axis=1, keepdims=True)
                assert got[at : at + n] == pytest.approx(want)
            at += n
    language.BLOCK_WORDS = 32


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in out if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)
    assert sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in out)


def test_words_of_code_switched_text(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    field = fit(docs.filter("lang IS NOT NULL"))
    english = "with the thanedble and attion to that this was for the are"
    german = "nicht der und die ist von das auf dem einer sich den"
    raw = f"{english} {german}".encode()
    share, _ = field.words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    best = [field.languages[k] for k in share.argmax(axis=1)]
    assert best[:11].count("en") >= 10 and best[-11:].count("de") >= 10


def test_language_of_awkward_rows(spark):
    rows = awkward_rows() + [row(60, "12 34 !!"), row(61, "日本"), row(62, "¿…")]
    out = {r.doc_id: r for r in languages(with_clashing_columns(frame(spark, rows))).collect()}
    for doc_id in (4, 5, 6, 60, 62):
        assert out[doc_id].lang_pred == "und" and out[doc_id].score == 0
    assert out[61].lang_pred == "en" and out[1].lang_pred == "en"
    assert languages(frame(spark, [])).count() == 0
    unlabelled = [row(1, words(1, 5), lang=None)]
    assert languages(frame(spark, unlabelled)).collect()[0].lang_pred == "und"


def test_field_without_words():
    field = Field(["a", "b"])
    assert field.documents(np.zeros(0, np.uint8), np.array([0, 0, 0])).shape == (2, 2)


def test_quality_scores_against_dense_equations(spark):
    """The same model from one dense matrix: features, ridge, and pooled rates by their min-max form."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = {r.doc_id: r.score for r in quality_scores(docs.repartition(7), labels).collect()}
    x = {r.doc_id: np.array(r.statistics) for r in document_statistics(docs).collect()}
    known = [(r.doc_id, r.quality) for r in labels.collect()
             if r.doc_id in x and zlib.crc32(str(r.doc_id).encode()) % 5 != 0]
    rows = np.array([x[i] for i, _ in known])
    y = np.array([q for _, q in known], float)

    rng = np.random.default_rng(quality.SEED)
    weights = rng.normal(size=(rows.shape[1], quality.FEATURES)) / np.sqrt(rows.shape[1])
    phase = rng.uniform(0, 2 * np.pi, quality.FEATURES)

    def features(v):
        z = np.clip((v - rows.mean(0)) / np.maximum(rows.std(0), 1e-6), -8, 8)
        waves = np.cos(z @ weights + phase) * np.sqrt(2 / quality.FEATURES)
        return np.hstack([waves, np.ones((len(v), 1))])

    z = features(rows)
    ridge = quality.RIDGE * len(y) / quality.FEATURES * np.diag([1.0] * quality.FEATURES + [0.0])
    solution = np.linalg.lstsq(z.T @ z + ridge, z.T @ y, rcond=None)[0]
    raw = z @ solution

    def steps(v):
        part = (v - raw.min()) / max(raw.max() - raw.min(), 1e-9) * quality.STEPS
        return np.clip(part, 0, quality.STEPS - 1).astype(int)

    n = np.bincount(steps(raw), minlength=quality.STEPS)
    ones = np.bincount(steps(raw), weights=y, minlength=quality.STEPS)
    used = np.flatnonzero(n)
    sums, sizes = np.append(0, np.cumsum(ones[used])), np.append(0, np.cumsum(n[used]))
    rates = [
        max(min((sums[b + 1] - sums[a]) / (sizes[b + 1] - sizes[a]) for b in range(k, len(used)))
            for a in range(k + 1))
        for k in range(len(used))
    ]
    rate = np.interp(np.arange(quality.STEPS), used, rates)
    ids = sorted(x)
    want = rate[steps(features(np.array([x[i] for i in ids])) @ solution)]
    off = np.abs(want - [got[i] for i in ids]) > 1e-6
    assert off.mean() <= 0.01  # a raw score on the edge of a step may round to either side


def test_languages_of_documents_are_means_over_their_words(spark):
    """A document's shares from its own words alone, ties to the first language in order."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    field = learnt_field(docs)
    out = {r.doc_id: r for r in languages(docs).collect()}
    for r in docs.limit(150).collect():
        raw = (r.text or "").encode()
        if not any(c.isalpha() for c in r.text or ""):
            continue
        share, _ = field.words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        mean = share.mean(axis=0)
        assert out[r.doc_id].lang_pred == field.languages[int(mean.argmax())]
        assert out[r.doc_id].score == pytest.approx(float(mean.max()), abs=1e-5)
    flat = Field(["de", "en"])
    raw = b"abc def"
    share = flat.documents(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    assert share[0, 0] == share[0, 1] and flat.languages[share.argmax()] == "de"
