from datetime import datetime

import pytest
from conftest import as_set, plan_of

from casemill.operators.engines import CallableEngine, TermRules
from casemill.operators.taxonomy import Domain
from casemill.plans import cycle
from casemill.sources.ledger import LEDGER, changed_sources, list_sources
from casemill.sources.keys import KEYS, stored_keys
from casemill.sources.store import Store, latest_snapshot, table_difference, write_snapshot
from casemill.streaming.intake import start_intake

DOMAINS = [Domain("pets", ("Dog", "Cat")), Domain("noise", ("Bar",))]
HEAD = "Número petición»Asunto»Fecha ingreso»Fecha registro»Otro campo\n"


def land(folder, name, *rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(HEAD + "".join(f"{r}\n" for r in rows), encoding="utf-8")
    return str(folder)


FIRST = ["1»a dog»2026-03-01»2026-03-02»x", "2»»2026-04-01»2026-04-02»y", "1»again»»»", "3»a bar»2026-03-05"]


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


def run(spark, source, store, engine=None, **options):
    engine = engine or TermRules({})
    return cycle.run_cycle(spark, source, store.root, DOMAINS, engine, **options)


def test_whole_cycle(spark, tmp_path, store):
    source, backup = land(tmp_path / "in", "a.csv", *FIRST), str(tmp_path / "backup")
    report = run(spark, source, store, snapshot_root=backup)
    assert report.load == cycle.LoadCounts(4, 3, 1, 0, 1)
    assert report.pending == {"pets": 0, "noise": 0}
    assert as_set(cycle.read_cases(store), "case_id", "subject", "otro_campo") == {
        ("1", "a dog", "x"), ("2", None, "y"), ("3", "a bar", None),
    }
    status = cycle.read_status(store)
    assert as_set(status, "domain", "case_id", "category", "method") == {
        ("pets", "1", "Dog", "IA"), ("noise", "1", None, "IA"), ("pets", "2", None, "VACIO"),
        ("noise", "2", None, "VACIO"), ("pets", "3", None, "IA"), ("noise", "3", "Bar", "IA"),
    }
    assert latest_snapshot(spark, backup) == report.snapshot
    saved = spark.read.parquet(f"{backup}/snapshot={report.snapshot}/status")
    assert as_set(saved) == as_set(status)

    assert run(spark, source, store).changed is False
    again = run(spark, source, store, force=True, snapshot_root=backup)
    assert (again.load.inserted, again.load.existing, again.snapshot) == (0, 4, None)
    assert as_set(cycle.read_status(store)) == as_set(status)

    land(tmp_path / "in", "b.csv", "3»changed»»»", "4»dog and cat»2026-05-01»»")
    more = run(spark, source, store, snapshot_root=backup)
    assert (more.load.processed, more.load.inserted) == (2, 1)
    assert cycle.read_cases(store).count() == 4 and cycle.read_status(store).count() == 8


def test_failed_rows_are_retried_by_the_next_run(spark, tmp_path, store):
    source = land(tmp_path / "in", "a.csv", *FIRST)
    down = CallableEngine(lambda: lambda batch: [None] * len(batch))
    assert run(spark, source, store, down).pending == {"pets": 2, "noise": 2}
    up = CallableEngine(lambda: lambda batch: ["NO_APLICA"] * len(batch))
    report = run(spark, source, store, up, force=True)
    assert report.load.inserted == 0 and report.pending == {"pets": 0, "noise": 0}


def test_new_domain_is_seeded_for_stored_cases(spark, tmp_path, store):
    run(spark, land(tmp_path / "in", "a.csv", *FIRST), store)
    extra = [*DOMAINS, Domain("birds", ("Owl",))]
    assert cycle.register_domains(store, extra) == ["birds"]
    assert cycle.register_domains(store, extra) == []
    assert cycle.read_status(store).filter("domain = 'birds' AND NOT processed").count() == 3
    assert cycle.classify_store(store, extra, TermRules({}))["birds"] == 0
    assert cycle.read_status(store).count() == 9


def test_reset_then_classify_restores(spark, tmp_path, store):
    run(spark, land(tmp_path / "in", "a.csv", *FIRST), store)
    before = as_set(cycle.read_status(store))
    cycle.reset_store(store, ["2026-03"])
    assert cycle.read_status(store).filter("NOT processed").count() == 4
    cycle.classify_store(store, DOMAINS, TermRules({}))
    assert as_set(cycle.read_status(store)) == before


def test_tag_keeps_the_state_without_a_copy(spark, tmp_path, store):
    stamp = run(spark, land(tmp_path / "in", "a.csv", *FIRST), store).snapshot
    before = as_set(cycle.read_cases(store))
    cycle.purge_store(store, ["2026"])
    assert cycle.read_cases(store).count() == 0
    assert as_set(store.read_tag(stamp, cycle.CASES)) == before
    with pytest.raises(ValueError, match="no table"):
        store.read_tag("never", cycle.CASES)


def test_purge_then_reload(spark, tmp_path, store):
    source = land(tmp_path / "in", "a.csv", *FIRST)
    run(spark, source, store)
    before = as_set(cycle.read_status(store))
    cycle.purge_store(store, ["2026-03"])
    assert as_set(cycle.read_cases(store), "case_id") == {("2",)}
    assert cycle.read_status(store).count() == 2
    assert run(spark, source, store, force=True).load.inserted == 2
    assert as_set(cycle.read_status(store)) == before


def test_rejects_get_no_status(spark, tmp_path, store):
    run(spark, land(tmp_path / "in", "a.csv", "1»x\x00y»»»", "2»ok»»»", "»no key»»»"), store)
    assert as_set(store.read("rejects", "reject_reason string"), "reject_reason") == {("nul_character",), ("missing_key",)}
    assert as_set(cycle.read_status(store), "case_id") == {("2",)}


def test_one_domain_only(spark, tmp_path, store):
    source = land(tmp_path / "in", "a.csv", *FIRST)
    down = CallableEngine(lambda: lambda batch: [None] * len(batch))
    run(spark, source, store, down)
    assert cycle.classify_store(store, DOMAINS[:1], TermRules({})) == {"pets": 0}
    assert as_set(cycle.read_pending(store), "domain", "case_id") == {("noise", "1"), ("noise", "3")}


def test_a_run_reads_the_texts_of_pending_loads_only(spark, tmp_path, store):
    source = land(tmp_path / "in", "a.csv", *FIRST)
    run(spark, source, store)
    land(tmp_path / "in", "b.csv", "9»a cat»2026-06-01»»")
    cycle.load_rows(store, cycle.read_export(spark, source), DOMAINS)
    cases = cycle.read_cases(store)
    needed = cycle.cases_of(cases, cycle.read_pending(store))
    assert as_set(needed, "case_id") == {("9",)}
    assert cases.select(cycle.LOAD).distinct().count() == 2
    assert "LeftSemi" in plan_of(needed)


def test_cases_are_not_dealt_by_their_load(spark, tmp_path, store):
    """All cases of a load have one load id: a shuffle by it would give them to one task."""
    run(spark, land(tmp_path / "in", "a.csv", *FIRST), store, CallableEngine(lambda: lambda b: [None] * len(b)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        needed = cycle.cases_of(cycle.read_cases(store), cycle.read_pending(store))
        plan = plan_of(needed)
        assert as_set(needed, "case_id") == {("1",), ("2",), ("3",)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_partial_purge_then_reload_keeps_the_other_rows(spark, tmp_path, store):
    source = land(tmp_path / "in", "a.csv", *FIRST)
    run(spark, source, store)
    before = as_set(cycle.read_status(store))
    cycle.purge_store(store, ["2026-03"], ["pets"])
    report = run(spark, source, store, force=True)
    assert (report.load.inserted, report.load.kept) == (2, 2)
    status = cycle.read_status(store)
    assert status.count() == status.select("domain", "case_id").distinct().count() == 6
    assert as_set(status) == before


def test_a_load_reads_no_finished_status(spark, tmp_path, store):
    """Seeds are a projection; only after a purge of some domains a note of its rows is compared."""
    source = land(tmp_path / "in", "a.csv", *FIRST)
    run(spark, source, store)
    cases = cycle.read_cases(store)
    plan = plan_of(cycle._seeds(store, cases, ["pets", "noise"]))
    assert "Join" not in plan and "Exchange" not in plan and "status" not in plan
    cycle.purge_store(store, ["2026-03"], ["pets"])
    assert as_set(store.read(cycle.LEFT, cycle.LEFT_ROWS)) == {("noise", "1"), ("noise", "3")}
    read = " ".join(cycle._seeds(store, cases, ["pets", "noise"]).inputFiles())
    assert "left_status" in read and "status_done" not in read and "status_pending" not in read
    assert run(spark, source, store, force=True).load.kept == 2
    cycle.purge_store(store, ["2026-03"])
    assert store.folders(cycle.LEFT) == []
    assert run(spark, source, store, force=True).load == cycle.LoadCounts(4, 2, 2, 0, 1, 0)
    assert cycle.read_status(store).count() == 6


def test_a_load_moves_no_texts(spark, tmp_path, store, monkeypatch):
    """Which rows are new is decided on keys; the texts go from the staged batch to the cases."""
    plans, write = [], cycle._write_cases

    def noted(target, cases):
        plans.append(plan_of(cases))
        return write(target, cases)

    monkeypatch.setattr(cycle, "_write_cases", noted)
    source = land(tmp_path / "in", "a.csv", *FIRST)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        counts = cycle.load_rows(store, cycle.read_export(spark, source), DOMAINS)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert (counts.inserted, counts.existing) == (3, 1)
    assert len(plans) == 1 and "subject" in plans[0] and plans[0].count("Exchange") == 1
    assert "subject" not in plans[0][plans[0].index("Exchange"):]


def test_rows_that_tie_are_one_case(spark, store):
    rows = spark.createDataFrame(
        [("1", "x"), ("1", "x"), ("2", "y"), ("2", "x"), (None, "x"), (None, "x")],
        "case_id string, subject string",
    ).selectExpr("*", "'2026-03-01' AS entry_date", "CAST(NULL AS STRING) AS register_date",
                 "false AS was_ragged", "struct(subject) AS load_order")
    counts = cycle.load_rows(store, rows, DOMAINS)
    assert counts == cycle.LoadCounts(6, 2, 2, 2, 0)
    assert cycle.read_cases(store).count() == 2
    assert as_set(cycle.read_cases(store), "case_id", "subject") == {("1", "x"), ("2", "x")}
    assert set(store.columns("rejects").fieldNames()).isdisjoint({"_row", "_chunk"})


def test_keys_follow_loads_and_purges(spark, tmp_path, store, monkeypatch):
    """Every load adds a folder of keys until they are written as one; a purge takes keys out."""
    monkeypatch.setattr(cycle, "MOST_PARTS", 2)
    sizes = []
    for i in range(4):
        rows = [f"{k}»t»2026-0{i + 1}-01»»" for k in range(3 * i, 3 * i + 4)]
        source = land(tmp_path / f"in{i}", "a.csv", *rows)
        counts = cycle.load_rows(store, cycle.read_export(spark, source), DOMAINS)
        assert counts.inserted == (4 if i == 0 else 3)
        sizes.append(len(store.folders(KEYS)))
    assert sizes == [1, 2, 1, 2]
    cycle.purge_store(store, ["2026-02"])
    with stored_keys(store) as keys:
        assert keys.count() == keys.distinct().count() == 10
        assert as_set(keys) == as_set(cycle.read_cases(store), "case_id")


def test_a_store_without_keys_gets_them(spark, tmp_path, store):
    source = land(tmp_path / "in", "a.csv", *FIRST)
    run(spark, source, store)
    old = Store(spark, str(tmp_path / "old"))
    old.append(cycle.CASES, cycle.read_cases(store))
    counts = cycle.load_rows(old, cycle.read_export(spark, source), DOMAINS)
    assert (counts.inserted, counts.existing) == (0, 4)
    with stored_keys(old) as keys:
        assert as_set(keys) == {("1",), ("2",), ("3",)}


def test_compaction_keeps_rows_and_tags(spark, tmp_path, store):
    source = land(tmp_path / "in", "a.csv", *FIRST)
    stamp = run(spark, source, store).snapshot
    land(tmp_path / "in", "b.csv", "9»a cat»2026-06-01»»")
    run(spark, source, store)
    cases, status = as_set(cycle.read_cases(store)), as_set(cycle.read_status(store))
    assert cycle.compact_store(store) == {cycle.CASES: 2, cycle.DONE: 2}
    assert [len(store.folders(n)) for n in (cycle.CASES, cycle.DONE)] == [1, 1]
    assert as_set(cycle.read_cases(store)) == cases and as_set(cycle.read_status(store)) == status
    assert cycle.compact_store(store) == {} and cycle.compact_store(store, 0) == {}
    assert store.read_tag(stamp, cycle.CASES).count() == 3
    assert run(spark, source, store, force=True).load.inserted == 0


def test_jobs_leave_no_staging_folders(spark, tmp_path, store):
    run(spark, land(tmp_path / "in", "a.csv", *FIRST), store)
    cycle.reset_store(store, ["2026-03"])
    calls = CallableEngine(lambda: lambda batch: ["NO_APLICA"] * len(batch))
    cycle.classify_store(store, DOMAINS, calls)
    for name in ("staging", "answers"):
        folder = tmp_path / "store" / name
        assert not folder.exists() or not list(folder.iterdir())


def test_empty_batch(spark, tmp_path, store):
    source = land(tmp_path / "in", "a.csv")
    counts = cycle.load_rows(store, cycle.read_export(spark, source), DOMAINS)
    assert counts == cycle.LoadCounts(0, 0, 0, 0, 0, 0)


def test_difference_of_two_tags(spark, store):
    kind = "k string, a string, b long"
    assert store.latest_tag() is None
    store.append("t", spark.createDataFrame([("1", "x", 1), ("2", None, 2), ("3", "y", 3)], kind))
    store.tag("2026-01")
    later = [("1", "x", 1, None), ("2", "", 2, None), ("4", None, None, None), ("5", "z", 1, "new")]
    store.replace("t", spark.createDataFrame(later, f"{kind}, c string"))
    store.tag("2026-02")
    assert store.latest_tag() == "2026-02"
    old, new = (store.read_tag(s, "t") for s in ("2026-01", store.latest_tag()))
    assert as_set(table_difference(old, new, "k")) == {
        ("2", "changed"), ("3", "removed"), ("4", "added"), ("5", "added"),
    }
    assert table_difference(new, new, ["k"]).count() == 0


def test_one_domain_run_seeds_all_domains(spark, tmp_path, store):
    source = land(tmp_path / "in", "a.csv", *FIRST)
    run(spark, source, store, only=["pets"])
    assert as_set(cycle.read_pending(store), "domain") == {("noise",)}
    run(spark, source, store, force=True)
    assert cycle.read_pending(store).count() == 0 and cycle.read_status(store).count() == 6


def test_reset_and_purge_leave_other_folders(spark, tmp_path, store):
    source = land(tmp_path / "in", "a.csv", *FIRST)
    run(spark, source, store)
    land(tmp_path / "in", "b.csv", "9»a cat»2026-06-01»»")
    run(spark, source, store)
    done, cases = store.folders(cycle.DONE), store.folders(cycle.CASES)
    cycle.reset_store(store, ["2026-06"])
    assert store.folders(cycle.DONE)[0] == done[0] and done[1] not in store.folders(cycle.DONE)
    assert cycle.read_pending(store).count() == 2
    cycle.purge_store(store, ["2026-06"])
    assert store.folders(cycle.CASES)[0] == cases[0] and cases[1] not in store.folders(cycle.CASES)
    assert cycle.read_status(store).count() == 6 and cycle.read_cases(store).count() == 3


def test_replacing_a_domain_seeds_what_is_missing(spark, tmp_path, store):
    run(spark, land(tmp_path / "in", "a.csv", *FIRST), store)
    cycle.purge_store(store, ["2026-03"], ["pets"])
    cycle.replace_domains(store, [Domain("noise", ("Loud",), ("bang",)), Domain("birds", ("Owl",))])
    known = {d.name: d for d in cycle.registered_domains(store)}
    assert set(known) == {"pets", "noise", "birds"} and known["noise"].keywords == ("bang",)
    assert as_set(cycle.read_pending(store), "domain", "case_id") == {("birds", "2")}


def test_an_engine_that_progresses_leaves_nothing(spark, tmp_path, store):
    """One more row in every pass: the loop ends when nothing is left."""
    seen = tmp_path / "seen"
    seen.mkdir()

    def factory():
        def predict(batch):
            done = len(list(seen.iterdir()))
            (seen / str(done)).touch()
            return ["Dog" if int(c) <= done + 1 else None for c in batch["case_id"]]

        return predict

    rows = [f"{i}»text»2026-03-01»»" for i in range(1, 6)]
    engine = CallableEngine(factory, retries=0, batch_rows=100, concurrency=1)
    report = cycle.run_cycle(
        spark, land(tmp_path / "in", "a.csv", *rows), store.root, DOMAINS[:1], engine
    )
    assert report.pending == {"pets": 0}


def test_files_are_read_by_their_own_headers(spark, tmp_path, store):
    source = land(tmp_path / "in", "a.csv", *FIRST)
    swapped = "Fecha ingreso»Número petición»Asunto»Nueva\n2026-02-01»7»a cat»n\n"
    (tmp_path / "in" / "b.csv").write_text(swapped, encoding="utf-8")
    run(spark, source, store)
    rows = cycle.read_cases(store)
    assert as_set(rows.filter("case_id = '7'"), "subject", "entry_date", "nueva", "otro_campo") == {
        ("a cat", "2026-02-01", "n", None)
    }
    assert rows.count() == 4


def test_unfinished_write_is_invisible(spark, store):
    rows = spark.createDataFrame([("a",)], "domain string")
    store.append("domains", rows)
    store.write_part("domains", rows)
    assert store.read("domains", "domain string").count() == 1
    store.replace("domains", rows.limit(0))
    assert store.read("domains", "domain string").count() == 0


def test_late_column_reads_as_null(spark, store):
    store.append("t", spark.createDataFrame([("1",)], "case_id string"))
    store.append("t", spark.createDataFrame([("2", "x")], "case_id string, extra string"))
    assert as_set(store.read("t", "case_id string"), "case_id", "extra") == {("1", None), ("2", "x")}


def test_stream_loads_each_file_once(spark, tmp_path, store):
    landing, checkpoint = land(tmp_path / "in", "a.csv", *FIRST), str(tmp_path / "ck")

    def drain():
        start_intake(store, landing, DOMAINS, checkpoint).awaitTermination()
        return as_set(cycle.read_cases(store), "case_id", "subject")

    one = drain()
    assert one == {("1", "a dog"), ("2", None), ("3", "a bar")}
    land(tmp_path / "in", "b.csv", "3»changed»»»", "4»new»»»")
    two = drain()
    assert two == one | {("4", "new")}
    assert drain() == two
    assert cycle.read_status(store).count() == 8
    batch = Store(spark, str(tmp_path / "batch"))
    run(spark, landing, batch)
    assert as_set(cycle.read_cases(batch), "case_id", "subject") == two


def test_changed_sources(spark):
    def listing(*rows):
        return spark.createDataFrame([(p, n, datetime(2026, 1, t)) for p, n, t in rows], LEDGER)

    ledger = listing(("a", 10, 1), ("b", 10, 1), ("c", 10, 1))
    now = listing(("a", 20, 1), ("b", 10, 2), ("c", 10, 1), ("d", 1, 1))
    assert as_set(changed_sources(now, ledger), "path") == {("a",), ("b",), ("d",)}
    assert changed_sources(now, ledger, force=True).count() == 4


def test_listing_reads_no_contents(spark, tmp_path):
    source = land(tmp_path / "in", "a.csv", *FIRST)
    rows = list_sources(spark, source).collect()
    assert rows[0].length == (tmp_path / "in" / "a.csv").stat().st_size
    assert "struct<path:string,modificationTime:timestamp,length:bigint>" in plan_of(
        list_sources(spark, source)
    )


def test_snapshot_gate(spark, tmp_path):
    rows = spark.createDataFrame([("a",)], "x string")
    root = str(tmp_path / "snap")
    assert latest_snapshot(spark, root) is None
    assert write_snapshot({"t": rows}, root, "20260101_000000", 0) is False
    assert write_snapshot({"t": rows}, root, "20260101_000000", 1) is True
    assert write_snapshot({"t": rows}, root, "20260201_000000", 5) is True
    assert latest_snapshot(spark, root) == "20260201_000000"
