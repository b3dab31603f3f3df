"""The whole run (P1): changed sources, load, classify, snapshot, with its gates.

Tables in the store: ``cases`` (append only, partitioned by load), ``status_pending`` and
``status_done`` (one status table in two parts, so a run rewrites the pending rows only),
``rejects``, ``ledger`` and ``domains`` (the registered taxonomy). ``case_keys`` holds the stored
case numbers in buckets, so a load costs its batch; ``left_status`` names the status rows that a
purge of some domains has left without a case, so that a load compares its seeds with those few
rows and not with all of the status. A status row remembers the load
of its case, so that a run over the pending rows reads the texts of those loads only, not the
whole master table. Reset and purge rewrite the folders that hold affected rows and no others.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casemill.operators.cascade import classify_in_passes, classify_pending
from casemill.operators.engines import TermRules
from casemill.operators.lifecycle import (
    cases_in_periods,
    purge_cases,
    purge_status,
    reset_status,
)
from casemill.operators.load import (
    CHUNK,
    REASON,
    ROW,
    accepted,
    new_keys,
    numbered,
    rejected,
    rows_numbered,
    tag_rejects,
)
from casemill.operators.status import missing_status, seed_status
from casemill.operators.taxonomy import Domain, load_domains, taxonomy_frame, upsert_taxonomy
from casemill.schema import STATUS, TAXONOMY
from casemill.session import folder_bytes, rows_stay_dealt
from casemill.sources.delimited import LOAD_ORDER, RAGGED, read_export
from casemill.sources.keys import KEYS, MOST_PARTS, key_buckets, stored_keys, write_keys
from casemill.sources.ledger import LEDGER, changed_sources, list_sources
from casemill.sources.store import (
    PART,
    Part,
    Store,
    part_token,
    table_difference,
    write_snapshot,
)

PENDING, DONE, CASES, DOMAINS = "status_pending", "status_done", "cases", "domains"
LEFT = "left_status"
#: Folders below this size are written together by a compaction.
SMALL_BYTES = 1 << 30
Stage = Callable[[str, DataFrame], DataFrame]
LOAD = "load_id"

STORED_STATUS = T.StructType([*STATUS.fields, T.StructField(LOAD, T.StringType())])
LEFT_ROWS = "domain string, case_id string"
NO_CASES = f"case_id string, subject string, entry_date string, register_date string, {LOAD} string"


@dataclass(frozen=True)
class LoadCounts:
    """processed = inserted + existing + rejected; ``ragged`` rows are among them.

    ``kept`` counts status rows that inserted cases had already, left by a partial purge;
    ``seconds`` is the time until the commit.
    """

    processed: int
    inserted: int
    existing: int
    rejected: int
    ragged: int
    kept: int = 0
    seconds: float = field(default=0.0, compare=False)

    @property
    def rows_per_second(self) -> float:
        return round(self.processed / self.seconds, 1) if self.seconds else 0.0


@dataclass(frozen=True)
class CycleReport:
    changed: bool
    load: LoadCounts | None = None
    snapshot: str | None = None
    pending: dict[str, int] = field(default_factory=dict)


def read_cases(store: Store) -> DataFrame:
    return store.read(CASES, NO_CASES)


def read_pending(store: Store) -> DataFrame:
    return store.read(PENDING, STORED_STATUS)


def read_done(store: Store) -> DataFrame:
    return store.read(DONE, STORED_STATUS)


def read_status(store: Store) -> DataFrame:
    return read_done(store).unionByName(read_pending(store)).drop(LOAD)


def _write_cases(store: Store, cases: DataFrame) -> Part:
    return store.write_part(CASES, cases, partition_by=[LOAD])


def _write_status(store: Store, name: str, status: DataFrame) -> Part:
    """Sorted by domain and case, so a single domain skips the row groups of the others."""
    return store.write_part(name, status, sort_by=["domain", "case_id"])


def _observed(df: DataFrame, **counts: Column) -> tuple[DataFrame, Observation]:
    """``df``, and the counts that are taken while it is written."""
    watch = Observation()
    return df.observe(watch, *[c.alias(n) for n, c in counts.items()]), watch


def _known_keys(store: Store) -> bool:
    """Whether the key table is there; a store of cases without one gets it with its next load."""
    return bool(store.folders(KEYS)) or not store.folders(CASES)


def _seeds(store: Store, inserted: DataFrame, names: Sequence[str]) -> DataFrame:
    """Pending rows of inserted cases. A projection, unless a purge of some domains has left
    status rows without a case; then those rows, and no others, are compared."""
    if not store.folders(LEFT):
        return seed_status(inserted, names, keep=[LOAD])
    left = store.read(LEFT, LEFT_ROWS).join(inserted.select("case_id"), "case_id", "left_semi")
    return missing_status(inserted, left, names, keep=[LOAD])


def load_rows(
    store: Store,
    rows: DataFrame,
    domains: Sequence[Domain],
    sources: DataFrame | None = None,
) -> LoadCounts:
    """S4 to S7 for one batch of canonical rows; all tables change in one commit.

    The batch is parsed once into a staging folder; rejects and inserts read that, and every count
    is taken while rows are written. Inserted cases are seeded for every registered domain; a
    status row that a partial purge has left stays as it is. ``sources`` are ledger rows to record
    with the batch.
    """
    started = time.monotonic()
    register_domains(store, domains)
    tagged, totals = _observed(
        tag_rejects(rows),
        processed=F.count(F.lit(1)),
        rejected=F.count(REASON),
        ragged=F.count_if(RAGGED),
    )
    chunks = int(store.spark.conf.get("spark.sql.shuffle.partitions"))
    with (
        store.scratch() as stage,
        store.bucketed("staging", numbered(tagged), CHUNK, chunks) as (staged, in_chunks),
    ):
        inserted, kept = _insert_new(store, stage, staged, in_chunks, chunks, sources)
    counts = totals.get
    return LoadCounts(
        processed=counts["processed"],
        inserted=inserted,
        existing=counts["processed"] - counts["rejected"] - inserted,
        rejected=counts["rejected"],
        ragged=counts["ragged"],
        kept=kept,
        seconds=round(time.monotonic() - started, 3),
    )


def _insert_new(
    store: Store,
    stage: Stage,
    staged: DataFrame,
    in_chunks: DataFrame,
    chunks: int,
    sources: DataFrame | None,
) -> tuple[int, int]:
    """Commit the new rows of a staged batch, its keys, seeds and rejects; how many rows were
    inserted, and how many status rows they had already.

    ``in_chunks`` are the rows of ``staged`` as a relation in ``chunks`` buckets of ``CHUNK``.
    """
    names = [d.name for d in registered_domains(store)]
    # Of rows that tie in their order the one with the smaller number is taken.
    places = accepted(staged).select("case_id", F.struct(LOAD_ORDER, ROW).alias(LOAD_ORDER))
    buckets = key_buckets(store)
    compact = len(store.folders(KEYS)) >= MOST_PARTS
    with stored_keys(store) as bucketed:
        known = bucketed if _known_keys(store) else read_cases(store).select("case_id")
        firsts = new_keys(places, known, LOAD_ORDER, buckets)
        wanted = stage("staging", firsts.select("case_id", F.col(LOAD_ORDER)[ROW].alias(ROW)))
        added_keys = wanted.select("case_id")
        whole = compact or not _known_keys(store)
        keys = write_keys(
            store,
            known.unionByName(added_keys) if whole else added_keys,
            key_buckets(store, rewritten=whole),
        )
    fresh, inserts = _observed(
        rows_numbered(accepted(in_chunks), wanted, chunks)
        .drop(LOAD_ORDER, RAGGED, ROW, CHUNK)
        .withColumn(LOAD, F.lit(uuid.uuid4().hex)),
        n=F.count(F.lit(1)),
    )
    with rows_stay_dealt(store.spark):
        cases = _write_cases(store, fresh)
    seeds, seeded = _observed(_seeds(store, store.open_part(cases), names), n=F.count(F.lit(1)))
    added = {
        CASES: cases,
        PENDING: _write_status(store, PENDING, seeds),
        "rejects": store.write_part("rejects", rejected(staged).drop(ROW, CHUNK)),
    }
    if sources is not None:
        added["ledger"] = store.write_part("ledger", sources)
    if whole:
        store.commit(append=added, replace={KEYS: keys})
    else:
        store.commit(append={**added, KEYS: keys})
    n_inserted = inserts.get["n"]
    return n_inserted, n_inserted * len(names) - seeded.get["n"]


def registered_domains(store: Store) -> list[Domain]:
    """The taxonomy that the store knows."""
    return load_domains(store.read(DOMAINS, TAXONOMY))


def _missing(store: Store, names: Sequence[str]) -> Part:
    """The pending rows that stored cases lack for these domains."""
    status = read_done(store).unionByName(read_pending(store))
    seeds = missing_status(read_cases(store), status, list(names), keep=[LOAD])
    return _write_status(store, PENDING, seeds)


def register_domains(store: Store, domains: Sequence[Domain]) -> list[str]:
    """S8 + S9: add the domains the store does not know yet and seed the stored cases for them."""
    known = {d.name for d in registered_domains(store)}
    added = [d for d in domains if d.name not in known]
    if added:
        rows = taxonomy_frame(store.spark, added)
        store.commit(
            append={
                DOMAINS: store.write_part(DOMAINS, rows),
                PENDING: _missing(store, [d.name for d in added]),
            }
        )
    return [d.name for d in added]


def replace_domains(store: Store, domains: Sequence[Domain]) -> None:
    """S9 as a job: add or replace these domains, and seed every stored case that lacks a row."""
    changed = taxonomy_frame(store.spark, domains)
    merged = upsert_taxonomy(store.read(DOMAINS, TAXONOMY), changed)
    store.commit(
        append={PENDING: _missing(store, [d.name for d in domains])},
        replace={DOMAINS: store.write_part(DOMAINS, merged)},
    )


def cases_of(cases: DataFrame, waiting: DataFrame) -> DataFrame:
    """The cases of the loads that waiting status rows belong to: a superset of what they need.

    The join is on the partition column, so loads without waiting rows aren't read. The list of
    loads, one row each, is broadcast: dealt by load, all cases of a load would go to one task.
    Which rows change is decided by the steps themselves, so a wider superset gives the same
    result.
    """
    return cases.join(F.broadcast(waiting.select(LOAD).distinct()), LOAD, "left_semi")


def classify_store(
    store: Store,
    domains: Sequence[Domain],
    engine,
    keyword_filter: bool = False,
    max_passes: int | None = None,
) -> dict[str, int]:
    """C1 to C11 over the pending rows of the given domains (F9); returns what is left (A10)."""
    with store.scratch() as stage:
        return _classify_store(store, stage, domains, engine, keyword_filter, max_passes)


def _classify_store(
    store: Store,
    stage: Stage,
    domains: Sequence[Domain],
    engine,
    keyword_filter: bool,
    max_passes: int | None,
) -> dict[str, int]:
    pending = read_pending(store)
    names = [d.name for d in domains]
    waiting = pending.filter(F.col("domain").isin(names))
    cases = cases_of(read_cases(store), waiting)
    if isinstance(engine, TermRules):
        result = classify_pending(pending, cases, domains, engine, keyword_filter)
    else:
        result = classify_in_passes(
            pending,
            cases,
            domains,
            engine,
            max_passes,
            keyword_filter,
            lambda df: stage("answers", df),
        )
    staged = stage("staging", result)
    done = _write_status(store, DONE, staged.filter("processed"))
    left = _write_status(store, PENDING, staged.filter(~F.col("processed")))
    store.commit(append={DONE: done}, replace={PENDING: left})
    rows = read_pending(store).groupBy("domain").count().collect()
    counts = {r["domain"]: r["count"] for r in rows}
    return {name: counts.get(name, 0) for name in names}


def _affected(store: Store, name: str, keys: DataFrame, domains: Sequence[str] | None) -> list[str]:
    """The folders of a status table with rows of these cases: one name per folder."""
    rows = store.read_parts(name, STORED_STATUS)
    if domains is not None:
        rows = rows.filter(F.col("domain").isin(list(domains)))
    hit = rows.select("case_id", PART).join(keys, "case_id", "left_semi")
    return [r[PART] for r in hit.select(PART).distinct().collect()]


def reset_store(
    store: Store, prefixes: Sequence[str], domains: Sequence[str] | None = None
) -> None:
    """P2 on the stored tables. Only folders of finished rows that hold affected ones are
    rewritten; the reset rows join the pending ones as a new folder."""
    cases = read_cases(store)
    keys = cases_in_periods(cases, prefixes).select("case_id")
    parts = _affected(store, DONE, keys, domains)
    if not parts:
        return
    touched = store.read_folders(DONE, parts)
    with store.scratch() as stage:
        staged = stage("staging", reset_status(touched, cases, prefixes, domains))
        store.commit(
            append={
                DONE: _write_status(store, DONE, staged.filter("processed")),
                PENDING: _write_status(store, PENDING, staged.filter(~F.col("processed"))),
            },
            drop={DONE: parts},
        )


def purge_store(
    store: Store, prefixes: Sequence[str], domains: Sequence[str] | None = None
) -> None:
    """P3 on the stored tables: status rows first chosen through the master, then the master.

    Folders without an affected row stay as they are, in all three tables. Status rows of the
    purged cases that stay, as their domain isn't named, are noted for the next loads.
    """
    cases = read_cases(store)
    keys = cases_in_periods(cases, prefixes).select("case_id")
    victims = cases_in_periods(store.read_parts(CASES, NO_CASES), prefixes)
    parts = [r[PART] for r in victims.select(PART).distinct().collect()]
    if not parts:
        return
    kept = purge_cases(store.read_folders(CASES, parts), prefixes)
    append: dict[str, Part] = {CASES: _write_cases(store, kept)}
    drop = {CASES: parts}
    for name in (PENDING, DONE):
        touched = _affected(store, name, keys, domains)
        if touched:
            rows = purge_status(store.read_folders(name, touched), cases, prefixes, domains)
            append[name], drop[name] = _write_status(store, name, rows), touched
    append_left, drop[LEFT] = _left_status(store, keys, domains)
    append.update(append_left)
    with stored_keys(store) as bucketed:
        known = bucketed if _known_keys(store) else cases.select("case_id")
        left_keys = known.join(keys, "case_id", "left_anti")
        replaced = write_keys(store, left_keys, key_buckets(store, rewritten=True))
    store.commit(append=append, replace={KEYS: replaced}, drop=drop)


def _left_status(
    store: Store, keys: DataFrame, domains: Sequence[str] | None
) -> tuple[dict[str, Part], list[str]]:
    """What a purge of ``keys`` leaves in the note of status rows without a case, as a new folder
    (none if it is empty) and the folders that go."""
    noted = [part_token(f) for f in store.folders(LEFT)]
    if domains is None and not noted:
        return {}, []
    rows = store.read(LEFT, LEFT_ROWS).join(keys, "case_id", "left_anti").select("domain", "case_id")
    if domains is not None:
        others = read_status(store).filter(~F.col("domain").isin(list(domains)))
        rows = rows.unionByName(
            others.join(keys, "case_id", "left_semi").select("domain", "case_id")
        )
    rows, watch = _observed(rows, n=F.count(F.lit(1)))
    part = store.write_part(LEFT, rows)
    return ({LEFT: part} if watch.get["n"] else {}), noted


def compact_store(store: Store, small_bytes: int = SMALL_BYTES) -> dict[str, int]:
    """Write the small folders of cases and status as one folder a table; how many went, by table.

    Loads add a folder each, so without this the list of folders grows with the loads. Large
    folders stay, so what is rewritten is bounded by the loads since the last time.
    """
    append, drop = {}, {}
    for name in (CASES, PENDING, DONE):
        small = [f for f in store.folders(name) if folder_bytes(store.spark, f) < small_bytes]
        if len(small) > 1:
            parts = [part_token(f) for f in small]
            rows = store.read_folders(name, parts)
            append[name] = (
                _write_cases(store, rows) if name == CASES else _write_status(store, name, rows)
            )
            drop[name] = parts
    if drop:
        store.commit(append=append, drop=drop)
    return {name: len(parts) for name, parts in drop.items()}


def tagged_difference(
    store: Store, since: str, until: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """What two tagged states differ in, as changed cases and changed status rows.

    Without ``until`` the latest tag is taken. The load of a row doesn't count.
    """
    until = until or store.latest_tag()
    if until is None:
        raise ValueError("the store has no tag")

    def status(stamp: str) -> DataFrame:
        parts = [store.read_tag(stamp, n, STORED_STATUS).drop(LOAD) for n in (PENDING, DONE)]
        return parts[0].unionByName(parts[1])

    cases = [store.read_tag(stamp, CASES, NO_CASES).drop(LOAD) for stamp in (since, until)]
    return (
        table_difference(cases[0], cases[1], "case_id"),
        table_difference(status(since), status(until), ["domain", "case_id"]),
    )


def run_cycle(
    spark: SparkSession,
    source: str,
    root: str,
    domains: Sequence[Domain],
    engine,
    snapshot_root: str | None = None,
    force: bool = False,
    multiline: bool = True,
    keyword_filter: bool = False,
    max_passes: int | None = None,
    only: Sequence[str] | None = None,
) -> CycleReport:
    """P1. Without a changed source the run ends early; ``force`` takes every file again.

    ``domains`` are registered and seeded; ``only`` limits the classification to some of them.

    Otherwise classification runs even when nothing was inserted, so rows that failed before are
    retried. Only when rows were inserted the new state is tagged, which copies nothing, and
    with a ``snapshot_root`` also copied there as a backup.
    """
    store = Store(spark, root)
    register_domains(store, domains)
    changed = changed_sources(list_sources(spark, source), store.read("ledger", LEDGER), force)
    # One row per file of the source, like the listing that any batch read keeps on the driver.
    files = [(r.path, r.length, r.modified) for r in changed.collect()]
    if not files:
        return CycleReport(changed=False)
    rows = read_export(spark, [path for path, _, _ in files], multiline)
    load = load_rows(store, rows, domains, spark.createDataFrame(files, LEDGER))
    chosen = [d for d in domains if only is None or d.name in only]
    pending = classify_store(store, chosen, engine, keyword_filter, max_passes)
    stamp = None
    if load.inserted:
        stamp = datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S")
        store.tag(stamp)
        if snapshot_root is not None:
            tables = {CASES: read_cases(store).drop(LOAD), "status": read_status(store)}
            write_snapshot(tables, snapshot_root, stamp, load.inserted)
    return CycleReport(True, load, stamp, pending)
