"""The stored path as queries: loads, streams, files and snapshots made from the benchmark tables.

Each one keeps its store in the session's shared folder under a name of its own.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.operators import evaluation
from casemill.operators.load import REASON, tag_rejects
from casemill.operators.taxonomy import taxonomy_frame
from casemill.plans import bindings as b
from casemill.plans import cycle
from casemill.plans.queries import LINE_ORDER, MONTH, MONTHS
from casemill.session import folder_bytes, staged, staging_path
from casemill.sources.delimited import (
    LOAD_ORDER,
    RAGGED,
    SEPARATOR,
    read_export,
    write_delimited,
    write_rows,
)
from casemill.sources.ledger import LEDGER, changed_sources, list_rows
from casemill.sources.store import Store
from casemill.streaming.intake import start_intake

#: Canonical columns and the headers that an export has for them.
HEADERS = {
    "case_id": "Número petición",
    "subject": "Asunto",
    "entry_date": "Fecha ingreso",
    "register_date": "Fecha registro",
}
CASE_COLUMNS = list(HEADERS)

#: Stored bytes of the tables behind one file of an export: a file whose fields hold line breaks is
#: read by one task.
EXPORT_BYTES = 32 << 20


def new_store(spark: SparkSession) -> Store:
    return Store(spark, staging_path(spark, "store"))


def _batch(rows: DataFrame, *order: Column) -> DataFrame:
    """Cases as a parsed export has them, placed by ``order``."""
    return rows.select(
        *CASE_COLUMNS, F.lit(False).alias(RAGGED), F.struct(*order).alias(LOAD_ORDER)
    )


def load_cases(store: Store, rows: DataFrame) -> cycle.LoadCounts:
    return cycle.load_rows(store, _batch(rows, F.col("case_id")), b.DOMAINS)


def _closed(cases: DataFrame) -> DataFrame:
    return cases.filter("order_status <> 'O'")


def whole_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load closed orders, classify one domain, reset a month, purge some, reload all."""
    store, cases = new_store(spark), b.cases(spark, sf_dir)
    load_cases(store, _closed(cases))
    cycle.classify_store(store, [d for d in b.DOMAINS if d.name == "contact"], b.RULES)
    cycle.reset_store(store, MONTH)
    cycle.purge_store(store, MONTHS)
    load_cases(store, cases)
    return cycle.read_status(store)


def reseed_after_partial_purge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A purge of two domains, then all orders again: those two are seeded anew only."""
    store, cases = new_store(spark), b.cases(spark, sf_dir)
    load_cases(store, _closed(cases))
    cycle.classify_store(store, b.DOMAINS, b.RULES)
    cycle.purge_store(store, MONTHS, b.DOMAIN_NAMES[:2])
    load_cases(store, cases)
    return cycle.read_status(store)


def load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5, S6 on stored tables: the counts of three loads, the last of order lines."""
    # Two loads take these cases: their texts meet them once.
    store, closed = new_store(spark), staged(_closed(b.cases(spark, sf_dir)), "cases")
    lines = b.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("case_id"),
        F.col("l_returnflag").alias("subject"),
        F.col("l_shipdate").cast("string").alias("entry_date"),
        F.lit(None).cast("string").alias("register_date"),
        *LINE_ORDER,
    )
    loads = [
        load_cases(store, closed.filter("order_status = 'F'")),
        load_cases(store, closed),
        cycle.load_rows(store, _batch(lines, *map(F.col, LINE_ORDER)), b.DOMAINS),
    ]
    return spark.createDataFrame(
        [(i, c.processed, c.inserted, c.existing, c.rejected) for i, c in enumerate(loads, 1)],
        "load int, processed long, inserted long, existing long, rejected long",
    )


def _export_files(spark: SparkSession, sf_dir: str, tables: list[str], least: int) -> int:
    """How many files an export of these tables has: more as they grow, so that none does."""
    stored = sum(folder_bytes(spark, f"{sf_dir}/{name}.parquet") for name in tables)
    return max(least, math.ceil(stored / EXPORT_BYTES))


def _write_export(cases: DataFrame, path: str, files: int) -> None:
    rows = cases.select(*[F.col(c).alias(h) for c, h in HEADERS.items()])
    write_delimited(rows.repartition(files, HEADERS["case_id"]), path)


def streamed_intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exports that land twice, the second time all orders with other texts; then no more.

    The stream takes half of the first export's files a batch and is started anew each time.
    """
    store, cases = new_store(spark), b.cases(spark, sf_dir, register_date=False)
    cases = cases.withColumn("register_date", F.lit(None).cast("string"))
    landing, checkpoint = staging_path(spark, "landing"), staging_path(spark, "stream")
    first = _export_files(spark, sf_dir, ["orders", "documents"], 4)
    second = _export_files(spark, sf_dir, ["orders"], 3)

    def drain() -> None:
        start_intake(
            store, f"{landing}/*", b.DOMAINS, checkpoint, files_per_batch=math.ceil(first / 2)
        ).awaitTermination()

    _write_export(_closed(cases), f"{landing}/first", first)
    drain()
    _write_export(cases.withColumn("subject", F.concat_ws(" ", F.lit("later"), "priority")),
                  f"{landing}/second", second)
    drain()
    drain()
    return cycle.read_cases(store).select("case_id", "subject", "entry_date")


def snapshot_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status rows added, changed and removed between the first and the latest tag."""
    store, cases = new_store(spark), b.cases(spark, sf_dir)
    load_cases(store, _closed(cases))
    cycle.classify_store(store, [d for d in b.DOMAINS if d.name == "contact"], b.RULES)
    store.tag("20260101_000000")
    first = store.latest_tag()
    cycle.reset_store(store, MONTH)
    cycle.purge_store(store, MONTHS)
    load_cases(store, cases.filter("order_status = 'O'"))
    store.tag("20260102_000000")

    return cycle.tagged_difference(store, first)[1]


def delimited_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts written as an export and read back, with broken rows beside them.

    The broken file has a row per supplier: two fields only, a NUL in the text, or no number and a
    field too many.
    """
    path = staging_path(spark, "export")
    documents = b.table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("case_id"),
        F.col("text").alias("subject"),
        F.col("lang").alias("entry_date"),
        F.col("source").alias("register_date"),
    )
    _write_export(documents, f"{path}/texts", _export_files(spark, sf_dir, ["documents"], 3))
    kind = F.col("s_suppkey") % 3
    key = F.concat(F.lit("s"), F.col("s_suppkey").cast("string"))
    line = (
        F.when(kind == 0, F.concat_ws(SEPARATOR, key, "s_name"))
        .when(kind == 1, F.concat(key, F.lit(f"{SEPARATOR}nul \0 "), "s_name",
                                  F.lit(f"{SEPARATOR}x{SEPARATOR}y")))
        .otherwise(F.concat_ws(SEPARATOR, F.lit(""), "s_name", F.lit("x"), F.lit("y"), key))
    )
    header = SEPARATOR.join(HEADERS.values())
    # One column and characters that no line has: lines are written as they are.
    as_lines = {"header": "true", "sep": "\x01", "quote": "\x02", "escape": "\x02"}
    broken = b.table(spark, sf_dir, "supplier").select(line.alias(header))
    broken.write.options(**as_lines).csv(f"{path}/broken")
    tagged = tag_rejects(read_export(spark, [f"{path}/texts", f"{path}/broken"]))
    return tagged.select(*CASE_COLUMNS, RAGGED, REASON)


def changed_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables whose rows changed since a ledger was kept, when only closed orders existed."""
    store = new_store(spark)
    tables = ["orders", "documents", "embeddings"]
    before = b.table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'")
    seen = list_rows(before)
    for name in tables[1:]:
        seen = seen.unionByName(list_rows(b.table(spark, sf_dir, name)))
    store.append("ledger", seen)
    listing = list_rows(b.table(spark, sf_dir, tables[0]))
    for name in tables[1:]:
        listing = listing.unionByName(list_rows(b.table(spark, sf_dir, name)))
    changed = changed_sources(listing, store.read("ledger", LEDGER))
    name = F.regexp_extract("path", r"/([a-z]+)\.parquet", 1)
    return changed.groupBy(name.alias("source")).agg(F.sum("length").alias("n_rows"))


def evaluation_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluated rows written as JSON lines and as CSV, and read back from both."""
    path = staging_path(spark, "evaluation")
    evaluated = evaluation.evaluate(b.labelled(spark, sf_dir), b.DOMAINS, b.CLOSED_RULES)
    columns = ["case_id", "domain", "original_category", "predicted", "match"]
    write_rows(evaluation.result_rows(evaluated), path, columns)
    kinds = "case_id string, domain string, original_category string, predicted string, match boolean"
    rows = spark.read.schema(kinds).json(f"{path}/json")
    flat = spark.read.schema(kinds).options(header="true", escape='"').csv(f"{path}/csv")
    return (
        rows.withColumn("in_json", F.lit(1))
        .withColumn("in_csv", F.lit(0))
        .unionByName(flat.withColumn("in_json", F.lit(0)).withColumn("in_csv", F.lit(1)))
        .groupBy(*columns)
        .agg(F.sum("in_json").alias("in_json"), F.sum("in_csv").alias("in_csv"))
    )


def evaluation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows a run evaluated, counted while its results are written."""
    path = staging_path(spark, "evaluation")
    evaluated = evaluation.evaluate(b.labelled(spark, sf_dir), b.DOMAINS, b.CLOSED_RULES)
    run = evaluation.write_results(evaluation.result_rows(evaluated), path)
    return spark.createDataFrame(
        [(run.total, run.matches, run.failures)], "total long, matches long, failures long"
    )


def registered_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A domain per document source, registered twice; the second time with labels."""
    store = new_store(spark)
    documents = b.table(spark, sf_dir, "documents").filter("source IS NOT NULL")
    labels = b.table(spark, sf_dir, "labels")

    def domains(rows: DataFrame) -> list[cycle.Domain]:
        topics = rows.groupBy("source").agg(
            F.array_sort(F.collect_set(F.coalesce("lang", F.lit("none")))).alias("names")
        )
        return [cycle.Domain(r.source, tuple(r.names), tuple(r.names)) for r in topics.collect()]

    cycle.replace_domains(store, domains(documents))
    cycle.replace_domains(store, domains(documents.join(labels, "doc_id")))
    return taxonomy_frame(spark, cycle.registered_domains(store)).select(
        "domain",
        F.array_join("categories", "|").alias("categories"),
        F.array_join("keywords", "|").alias("keywords"),
    )


STORE_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q
    for q in [
        whole_run,
        reseed_after_partial_purge,
        load_counts,
        streamed_intake,
        snapshot_difference,
        delimited_round_trip,
        changed_tables,
        evaluation_files,
        evaluation_counts,
        registered_domains,
    ]
}
