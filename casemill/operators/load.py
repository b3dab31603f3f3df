"""Intake: rejects (S4), insert-if-absent (S5) and exact accounting.

Rows that are all key and numbers are decided in one exchange (``new_rows``). Rows with texts are
decided on keys and places alone (``new_keys``) against the bucketed key table, whose rows stay
where they are; only the new rows are then fetched (``rows_at``). A batch that is stored in buckets
of its own chunks (``numbered``) keeps its rows where they are in that step too: the numbers of the
new rows go to the chunks, and no text moves, however many rows are new.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

REASON = "reject_reason"
#: The number of a row in its batch, and that of the rows numbered with it.
ROW, CHUNK = "_row", "_chunk"
#: A chunk has up to 2 ** CHUNK_BITS rows of one task, so no bucket of chunks gets many more rows.
CHUNK_BITS = 20
MISSING_KEY = "missing_key"
NUL_CHARACTER = "nul_character"


def tag_rejects(rows: DataFrame, key: str = "case_id") -> DataFrame:
    """Add ``reject_reason``; NULL means the row can be stored."""
    texts = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.StringType)]
    has_nul = reduce(
        or_, [F.coalesce(F.col(c).contains("\0"), F.lit(False)) for c in texts], F.lit(False)
    )
    reason = F.when(F.col(key).isNull(), MISSING_KEY).when(has_nul, NUL_CHARACTER)
    return rows.withColumn(REASON, reason)


def accepted(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col(REASON).isNull()).drop(REASON)


def rejected(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col(REASON).isNotNull())


def first_per_key(rows: DataFrame, order: Sequence[Column], key: str = "case_id") -> DataFrame:
    """The first row of each key under ``order`` (which must be total to be repeatable)."""
    w = Window.partitionBy(key).orderBy(*order)
    return rows.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def new_rows(
    incoming: DataFrame, stored_keys: DataFrame, order: Sequence[Column], key: str = "case_id"
) -> DataFrame:
    """S5 for narrow rows: what an insert-if-absent of ``incoming`` would add; the first wins.

    One exchange of the rows, cut to one per key and map task before it; the anti-join shares it.
    Of rows that tie in ``order`` any one is taken.
    """
    return first_per_key(incoming, order, key).join(stored_keys.select(key), key, "left_anti")


def new_keys(
    incoming: DataFrame, stored_keys: DataFrame, order: str, buckets: int, key: str = "case_id"
) -> DataFrame:
    """S5 for wide rows, first half: key and place of the rows to insert.

    ``stored_keys`` are in ``buckets`` buckets: only the batch's keys move, to the buckets' own
    partitions, after copies of a key have become one per map task. ``order`` is the column of a
    row's place and must be total.
    """
    firsts = incoming.groupBy(key).agg(F.min(order).alias(order)).repartition(buckets, key)
    # Spark would push an anti-join below the repartition and then move the stored keys instead.
    stored = stored_keys.select(key, F.lit(True).alias("_stored"))
    return firsts.join(stored, key, "left").filter("_stored IS NULL").drop("_stored")


def rows_at(
    incoming: DataFrame, wanted: DataFrame, order: str, key: str = "case_id"
) -> DataFrame:
    """S5 for wide rows, second half: the rows of ``incoming`` at the wanted keys and places."""
    return incoming.join(wanted.select(key, order), [key, order], "left_semi")


def _chunk(row: Column) -> Column:
    return F.shiftright(row, CHUNK_BITS)


def numbered(rows: DataFrame) -> DataFrame:
    """Give each row a number and a chunk of its task. To be written once and read from there."""
    return rows.withColumn(ROW, F.monotonically_increasing_id()).withColumn(
        CHUNK, _chunk(F.col(ROW))
    )


def rows_numbered(incoming: DataFrame, wanted: DataFrame, buckets: int) -> DataFrame:
    """``rows_at`` for a batch that lies in ``buckets`` buckets of its chunks: only the wanted
    numbers move, if it runs under ``rows_stay_dealt``. They are looked up in a hash table, so the
    rows aren't sorted either."""
    places = wanted.select(ROW, _chunk(F.col(ROW)).alias(CHUNK)).repartition(buckets, CHUNK)
    return rows_at(incoming, places.hint("shuffle_hash"), ROW, CHUNK)


def load_accounting(
    tagged: DataFrame, stored_keys: DataFrame, key: str = "case_id"
) -> DataFrame:
    """One row ``processed, inserted, existing, rejected`` with exact counts.

    A later copy of a key inside the batch counts as existing. Only keys are shuffled, after a
    map-side count per key.
    """
    usable = F.col(REASON).isNull()
    per_key = (
        tagged.groupBy(F.when(usable, F.col(key)).alias(key))
        .agg(F.count("*").alias("n"))
        .join(stored_keys.select(key, F.lit(True).alias("stored")), key, "left")
    )
    is_new = F.col(key).isNotNull() & F.col("stored").isNull()
    counts = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("processed"),
        F.count_if(is_new).alias("inserted"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), F.lit(0)).alias("rejected"),
    )
    return counts.select(
        "processed",
        "inserted",
        (F.col("processed") - F.col("inserted") - F.col("rejected")).alias("existing"),
        "rejected",
    )
