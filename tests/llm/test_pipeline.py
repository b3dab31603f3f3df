"""The pipeline, stage by stage, against plain versions of each."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from casemill.llm.language import languages
from casemill.llm.mixing import mix_sources
from casemill.llm.pii import redact
from casemill.llm.tokens import vocabulary_path
from tests.llm.helpers import awkward_rows, frame, row, words
from tests.llm.test_near_join import brute
from tests.llm.test_tokens import check_packing


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_stages(spark):
    rows = [r for r in awkward_rows() if r[0] != 16]
    rows += [row(100 + i, words(i, 20 + i), source=f"src{i % 3}") for i in range(60)]
    rows += [row(300 + i, words(i, 20 + i), source="src1") for i in range(20)]
    rows += [row(400, "write to a.b@c.org or +1 (499) 555-6503 " + words(77, 30))]
    docs = frame(spark, rows)
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "near duplicates", "personal data", "mix", "pack"]

    kept = stages["language"](spark, docs, "")
    want = {r.doc_id for r in languages(docs).collect() if r.lang_pred != "und" and r.score >= corpus_pipeline.LEAST_LANGUAGE_SHARE}
    assert kept.columns == docs.columns
    assert rows_of(kept) == sorted((r for r in rows if r[0] in want), key=str)

    unique = stages["near duplicates"](spark, kept, "")
    kept_rows = rows_of(kept)
    stay = {r[0] for r in brute(kept_rows) if r[4]}
    assert rows_of(unique) == sorted((r for r in kept_rows if r[0] in stay), key=str)

    clean = stages["personal data"](spark, unique, "")
    want = []
    for doc_id, text, lang, source, _ in rows_of(unique):
        text = redact(text)
        want.append((doc_id, text, lang, source, len(text)))
    assert rows_of(clean) == sorted(want, key=str)
    assert "[EMAIL]" in next(r[1] for r in want if r[0] == 400)

    mix = stages["mix"](spark, clean, "")
    passes = {r.doc_id: r.passes for r in mix_sources(clean).collect()}
    want = [r for r in rows_of(clean) for _ in range(passes[r[0]])]
    assert rows_of(mix) == sorted(want, key=str) and mix.columns == docs.columns

    out = stages["pack"](spark, mix, "").collect()
    check_packing(out, rows_of(mix), Tokenizer.from_file(vocabulary_path()), 4096)


def test_near_duplicates_keep_one_row_of_each_document(spark):
    rows = [row(1, words(1, 30)), row(1, words(1, 30)), row(None, words(1, 30)), row(2, words(1, 30))]
    out = corpus_pipeline.drop_near_duplicates(spark, frame(spark, rows), "").collect()
    assert Counter(r.doc_id for r in out) == {1: 1, None: 1}


def test_mix_repeats_equal_rows(spark):
    rows = [row(1, "a b c")] * 3 + [row(2, "d e", source="s2")]
    docs = frame(spark, rows)
    total = sum(r.passes for r in mix_sources(docs).collect())
    assert corpus_pipeline.mix_by_weight(spark, docs, "").count() == total


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_empty_input(spark, name):
    assert dict(corpus_pipeline.STAGES)[name](spark, frame(spark, []), "").count() == 0


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_extra_columns_named_like_inner_ones(spark, name):
    """A stage gives the same rows whatever other columns are called, and carries them along."""
    rows = [r for r in awkward_rows() if r[0] != 16] + [row(20 + i, words(i % 3, 30)) for i in range(6)]
    docs, stage = frame(spark, rows), dict(corpus_pipeline.STAGES)[name]
    extra = ["kept_id", "Kept_Row", "kept", "mix_id", "mix_draw", "mix_passes", "mix_row", "mix_pass",
             "mix__id", "mix__passes", "rep", "component", "class_id", "size", "passes", "draw", "d",
             "k", "spans", "lang_pred", "score", "held_out", "piece", "lot", "h1", "ids"]
    clashing = docs.select("*", *[F.lit(n).alias(n) for n in extra])
    plain, out = stage(spark, docs, ""), stage(spark, clashing, "")
    if name == "pack":
        assert out.columns == plain.columns and out.count() == plain.count()
        return
    assert out.columns == clashing.columns
    assert rows_of(out.select(*docs.columns)) == rows_of(plain)
    assert out.filter("kept_id <> 'kept_id' OR mix_pass <> 'mix_pass'").count() == 0
