"""Document fingerprints: one-permutation MinHash with optimal densification, packed to low bits.

Everything here is DataFrame expressions. The word shingles of a text are hashed once; the high
bits of a hash name its bin, and each bin keeps its smallest hash. An empty bin borrows from a
donor bin that its own fixed random sequence names first among those that aren't empty, so two
texts with the same bins borrow alike. Of each bin only the low ``BITS`` bits are stored; the
likeness of two fingerprints takes off the matches that so few bits give by chance.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casemill.llm.shared import id_column
from casemill.session import staged

WIDTH = 5
BIN_BITS = 8
BINS = 1 << BIN_BITS
BITS = 8
#: Taken off the low bits, so that they fit a signed byte.
LOWEST = 1 << (BITS - 1)
#: Donors an empty bin tries in its sequence; if all are empty, the nearest by a hash is taken.
TRIES = 8
SEED = 11
#: Stands for a missing doc_id in join keys, where null equals nothing; no id of its own.
_NO_ID = -(2**63)


def _donors() -> list[list[int]]:
    draw = random.Random(SEED)
    return [[draw.randrange(BINS) for _ in range(TRIES)] for _ in range(BINS)]


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def shingles(words: Column) -> Column:
    """Sorted hashes of the shingles of a column of words; null without words, one for few."""
    many = F.transform(
        F.sequence(F.lit(0), F.size(words) - WIDTH),
        lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(WIDTH)]),
    )
    few = F.array(F.xxhash64(words))
    return F.when(F.size(words) >= WIDTH, F.sort_array(many)).when(F.size(words) > 0, few)


def _bin(hashed: Column) -> Column:
    """The bin of a hash, by its high bits; sorted hashes have ascending bins."""
    return (F.shiftright(hashed, 64 - BIN_BITS) + BINS // 2).cast("int")


def _with_fingerprint(df: DataFrame, text: Column, name: str) -> DataFrame:
    """Add ``name``: low bits of each bin, or an empty array for a text without words.

    The steps are columns of their own, so that none is computed twice.
    """
    words, hashes = f"{name}__words", f"{name}__hashes"
    least, bins = f"{name}__least", f"{name}__bins"
    keep = df.columns
    df = df.select(*keep, words_of(text).alias(words))
    df = df.select(*keep, shingles(F.col(words)).alias(hashes))
    sorted_hashes = F.col(hashes)
    firsts = F.filter(
        sorted_hashes,
        lambda h, i: (i == 0) | (_bin(h) != _bin(F.get(sorted_hashes, i - 1))),
    )
    df = df.select(*keep, firsts.alias(least))
    low = F.col(least)
    gaps = F.transform(
        low,
        lambda h, i: F.concat(
            F.array_repeat(
                F.lit(None).cast("long"),
                _bin(h)
                - F.when(i == 0, F.lit(-1)).otherwise(_bin(F.get(low, i - 1)))
                - 1,
            ),
            F.array(h),
        ),
    )
    tail = F.array_repeat(
        F.lit(None).cast("long"), F.lit(BINS - 1) - _bin(F.element_at(low, -1))
    )
    df = df.select(*keep, F.col(least), F.concat(F.flatten(gaps), tail).alias(bins))
    held = F.col(bins)
    donors = F.array(*[F.array(*[F.lit(d) for d in row]) for row in _donors()])

    def borrow(tries: Column, i: Column) -> Column:
        first = F.get(
            F.filter(F.transform(tries, lambda t: F.get(held, t)), lambda x: x.isNotNull()), 0
        )
        # Of the few bins of a short text, the one that a hash with the bin's number puts first.
        by_hash = F.array_min(
            F.transform(
                F.col(least),
                lambda h: F.struct(F.xxhash64(_bin(h), i).alias("r"), h.alias("h")),
            )
        )["h"]
        return F.coalesce(F.get(held, i), first, by_hash)

    filled = F.transform(donors, borrow)
    # One signed byte a bin: rows of these are staged and shuffled.
    packed = F.transform(
        filled, lambda h: (h.bitwiseAND((1 << BITS) - 1) - LOWEST).cast("tinyint")
    )
    return df.select(
        *keep,
        F.when(held.isNotNull(), packed).otherwise(F.array().cast("array<tinyint>")).alias(name),
    )


def packed_text(fingerprint: Column) -> Column:
    """The fingerprint as lowercase hex digits."""
    digits = F.array(*[F.lit(f"{v:02x}") for v in range(1 << BITS)])
    return F.array_join(
        F.transform(fingerprint, lambda v: F.get(digits, v.cast("int") + LOWEST)), ""
    )


def likeness(a: Column, b: Column) -> Column:
    """Estimated similarity of two fingerprints, chance matches of the low bits taken off."""
    same = F.aggregate(
        F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda t, x: t + x
    )
    chance = 1 / (1 << BITS)
    estimate = F.greatest((same / BINS - chance) / (1 - chance), F.lit(0.0))
    return (
        F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0))
        .when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0))
        .otherwise(estimate)
    )


def next_documents(keys: DataFrame) -> DataFrame:
    """For each distinct key (id_key, mark; n_chars) the next one by descending id_key, the first
    after the last.

    Range partitions are numbered, each looks ahead within itself, and the last of each takes the
    first of the following partition from a list with one row a partition.
    """
    ranged = keys.repartitionByRange(F.desc("id_key")).withColumn("part", F.spark_partition_id())
    ranged = staged(ranged, "order").dropDuplicates(["id_key", "mark", "part"])
    order = [F.desc("id_key"), F.asc("mark")]
    key = F.struct("id_key", "mark")
    inner = Window.partitionBy("part").orderBy(*order)
    ahead = ranged.withColumn("ahead", F.lead(key).over(inner))
    firsts = ranged.groupBy("part").agg(
        F.min_by(key, F.struct(F.bitwise_not("id_key"), F.col("mark"))).alias("head")
    )
    parts = Window.orderBy("part")
    everywhere = parts.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = firsts.select(
        "part",
        F.coalesce(F.lead("head").over(parts), F.first("head").over(everywhere)).alias("head"),
    )
    chosen = F.coalesce("ahead", "head")
    return ahead.join(heads, "part").select(
        "id_key",
        "mark",
        "n_chars",
        chosen["id_key"].alias("next_id"),
        chosen["mark"].alias("next_mark"),
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint of each row's text and of its edited text, and how alike they are.

    The edited text has its last floor(n_chars / 3) code points replaced by the first as many (or
    all) of the next document by descending doc_id. Returns doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint (hex digits; none for a text without words), near_edited and
    near_next. A null text is empty. A missing doc_id comes after all others; among rows of one
    doc_id the texts' hashes decide; rows that repeat both count as one document in the order.
    Texts of any length are printed whole. An empty table gives an empty result; other columns are
    ignored, whatever their names.
    """
    rows = docs.select(
        id_column(docs),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    rows = rows.select(
        F.coalesce("doc_id", F.lit(_NO_ID)).alias("id_key"),
        F.xxhash64("text").alias("mark"),
        F.length("text").cast("long").alias("n_chars"),
        "text",
    )
    order = staged(next_documents(rows.select("id_key", "mark", "n_chars")), "next")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The same three columns for both joins below: the exchange is made once and used twice.
    texts = rows.select("id_key", "mark", "text").repartition(n, "id_key", "mark")
    # What each document gives to the one before it.
    heads = (
        texts.join(
            order.select(
                F.col("next_id").alias("id_key"),
                F.col("next_mark").alias("mark"),
                F.col("id_key").alias("for_id"),
                F.col("mark").alias("for_mark"),
                F.floor(F.col("n_chars") / 3).cast("int").alias("wanted"),
            ),
            ["id_key", "mark"],
        )
        .select(
            F.col("for_id").alias("id_key"),
            F.col("for_mark").alias("mark"),
            F.col("id_key").alias("next_id"),
            F.col("mark").alias("next_mark"),
            F.substring("text", 1, F.col("wanted")).alias("head"),
        )
        .dropDuplicates(["id_key", "mark"])
    )
    third = F.floor(F.col("n_chars") / 3).cast("int")
    edited = F.concat(F.substring("text", 1, F.col("n_chars").cast("int") - third), "head")
    both = texts.join(heads, ["id_key", "mark"]).withColumns(
        {
            "doc_id": F.nullif("id_key", F.lit(_NO_ID)),
            "n_chars": F.length("text").cast("long"),
        }
    ).select(
        "doc_id", "id_key", "mark", "next_id", "next_mark", "n_chars", "text", edited.alias("edited")
    )
    both = _with_fingerprint(both, F.col("text"), "own")
    both = _with_fingerprint(both, F.col("edited"), "changed")
    printed = staged(
        both.select(
            "doc_id", "id_key", "mark", "next_id", "next_mark", "n_chars",
            F.sha2("edited", 256).alias("edited_sha256"), "own", "changed",
        ),
        "fingerprints",
    )
    following = printed.select(
        F.col("id_key").alias("next_id"), F.col("mark").alias("next_mark"), F.col("own").alias("after")
    ).dropDuplicates(["next_id", "next_mark"])
    return printed.join(following, ["next_id", "next_mark"]).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        packed_text(F.col("own")).alias("fingerprint"),
        packed_text(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("after")).alias("near_next"),
    )
