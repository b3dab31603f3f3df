"""Small document tables with the awkward cases every operator must take."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed: int, n: int, alphabet: str = "abcdefgh") -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(alphabet, k=rng.randint(2, 7))) for _ in range(n))


def row(doc_id, text, lang="en", source="src0"):
    return (doc_id, text, lang, source, None if text is None else len(text))


def awkward_rows() -> list[tuple]:
    """Nulls in every column, empty and long texts, ties, repeated rows, odd white space."""
    shared = words(5, 40)
    rows = [
        row(1, words(1, 60)),
        row(2, words(1, 60), source="src1"),
        row(3, words(1, 58) + " zzz yyy", source=None),
        row(4, None),
        row(5, ""),
        row(6, "   \n\t "),
        row(7, "one two"),
        row(8, "one two", lang=None),
        row(9, words(9, 6000), source="src2"),
        row(10, words(10, 30) + " " + shared, source="src2"),
        row(11, words(11, 50) + " " + shared + " " + words(12, 9), source="src1"),
        row(12, "größe naïve Été mañana ñandú 日本語 текст ΣΑΣ İstanbul éte   x\x1cy"),
        row(13, "<|endoftext|> It's we'll <|EndOfText|> A.B,C;;; 12.5% don't!!"),
        row(14, words(14, 80), source="src3"),
        row(None, words(15, 20), source="src3"),
        row(16, words(14, 80), source="src3"),
        row(16, words(14, 80), source="src3"),
    ]
    return rows


def frame(spark, rows=None):
    return spark.createDataFrame(awkward_rows() if rows is None else rows, SCHEMA)


def with_clashing_columns(df):
    """The same rows with extra columns named like those the operators use inside."""
    from pyspark.sql import functions as F

    names = [
        "size", "part", "lot", "spans", "node", "rep", "key", "bin", "grp", "label", "score",
        "mark", "mark2", "id_key", "draw", "text_id", "kept_id", "class_id", "h1", "h2", "signature",
        "first_id", "version", "batch", "payload", "shard", "block", "point", "statistics", "quality",
        "piece", "start", "length", "offset", "place", "target", "taken", "passes", "n_tokens",
        "token_ids", "decoded", "held_out", "lang_pred", "next_id", "edited", "own", "whole", "n_bytes",
    ]
    return df.select("*", *[F.lit(n).alias(n) for n in names])
