from conftest import as_set, plan_of
from pyspark.sql import functions as F

from casemill.operators import load
from casemill.operators.status import missing_status, orphan_count, seed_status
from casemill.operators.taxonomy import (
    Domain, dump_taxonomy, load_domains, parse_taxonomy, shipped_domains, taxonomy_frame,
    upsert_taxonomy,
)
from casemill.schema import STATUS, add_missing_columns
from casemill.sources.delimited import (
    LOAD_ORDER, RAGGED, read_export, read_headers, write_delimited,
)
from casemill.session import rows_stay_dealt
from casemill.sources.keys import KEYS, key_buckets, stored_keys, write_keys
from casemill.sources.store import Store


def write_bytes(path, data: bytes):
    path.write_bytes(data)
    return str(path)


def export(tmp_path, body: str, name="e.csv"):
    head = "﻿Número petición»Asunto»Fecha ingreso\n"
    return write_bytes(tmp_path / name, (head + body).encode())


def test_ragged_rows_are_padded_cut_and_flagged(spark, tmp_path):
    for multiline in (True, False):
        rows = read_export(spark, export(tmp_path, "1»a\n2»b»2026-03-01»x\n3»c»2026-03-02\n"), multiline)
        assert as_set(rows, "case_id", "subject", "entry_date", RAGGED) == {
            ("1", "a", None, True),
            ("2", "b", "2026-03-01", True),
            ("3", "c", "2026-03-02", False),
        }
        # also when few columns are read
        assert rows.filter(F.col(RAGGED) & F.col("case_id").isNotNull()).count() == 2


def test_quotes_and_line_breaks(spark, tmp_path):
    rows = read_export(spark, export(tmp_path, '1»"a ""q"" »x\r\ny"»2026-03-01\n'))
    assert rows.head().subject == 'a "q" »x\ny'


def test_empty_fields_are_null(spark, tmp_path):
    rows = read_export(spark, export(tmp_path, '1»»2026-03-01\n2»""»2026-03-01\n'))
    assert as_set(rows, "case_id", "subject") == {("1", None), ("2", None)}


def test_bad_bytes_are_replaced_and_nul_is_rejected(spark, tmp_path):
    data = "Número petición»Asunto\n".encode() + b"1\xc2\xbbab\xffc\n2\xc2\xbbx\x00y\n\xc2\xbbno key\n"
    rows = load.tag_rejects(read_export(spark, write_bytes(tmp_path / "b.csv", data)))
    assert as_set(load.accepted(rows), "case_id", "subject") == {("1", "ab�c")}
    assert as_set(load.rejected(rows), "case_id", load.REASON) == {
        ("2", load.NUL_CHARACTER),
        (None, load.MISSING_KEY),
    }


def test_first_occurrence_wins_and_counts_are_exact(spark, make_cases):
    rows = make_cases(("1", "first", "a"), ("1", "second", "b"), ("2", "new text", "c"), (None, "x", "d"))
    tagged = load.tag_rejects(rows)
    stored = make_cases(("2", "stored"))
    fresh = load.new_rows(load.accepted(tagged), stored, [F.col("entry_date")])
    assert as_set(fresh, "case_id", "subject") == {("1", "first")}
    assert load.load_accounting(tagged, stored).head().asDict() == {
        "processed": 4, "inserted": 1, "existing": 2, "rejected": 1,
    }
    again = load.load_accounting(tagged, stored.unionByName(fresh)).head()
    assert (again.inserted, again.existing) == (0, 3)


def test_accounting_of_nothing(spark, make_cases):
    empty = make_cases().filter("false")
    counts = load.load_accounting(load.tag_rejects(empty), empty).head()
    assert tuple(counts) == (0, 0, 0, 0)


def test_file_order_across_splits(spark, tmp_path):
    """The first row in the file wins although several tasks read it."""
    filler = "".join(f"k{i}»{'t' * 50}»2026\n" for i in range(20_000))
    path = export(tmp_path, f"dup»first»2026\n{filler}dup»last»2026\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200000")
    try:
        rows = read_export(spark, path, multiline=False)
        assert rows.rdd.getNumPartitions() > 3
        kept = load.first_per_key(rows, [F.col(LOAD_ORDER)])
        assert kept.filter("case_id = 'dup'").head().subject == "first"
        assert kept.count() == 20_001
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_copies_are_cut_before_the_shuffle(spark, make_cases):
    rows = make_cases(*[("hot", str(i), str(i)) for i in range(100)], ("a", "x", "0"))
    plan = plan_of(load.new_rows(rows, make_cases(("a",)), [F.col("entry_date")]))
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert plan.index("Final") < plan.index("Partial")


def test_seed_and_sync(spark, make_cases, make_status):
    cases = make_cases(("1",), ("2",))
    seeded = seed_status(cases, ["a", "b"])
    assert as_set(seeded) == {(d, k, None, False, None) for d in "ab" for k in "12"}
    assert "Exchange" not in plan_of(seeded) and "Join" not in plan_of(seeded)
    part = make_status(("a", "1", "X", True, "IA"), ("b", "gone", None, False, None))
    missing = missing_status(cases, part, ["a", "b"])
    assert as_set(missing, "domain", "case_id") == {("b", "1"), ("a", "2"), ("b", "2")}
    assert missing_status(cases, part.unionByName(missing), ["a", "b"]).count() == 0
    assert as_set(orphan_count(part, cases)) == {("b", 1)}


def test_taxonomy_round_trip_and_upsert(spark):
    frame = taxonomy_frame(spark, shipped_domains())
    back = parse_taxonomy(dump_taxonomy(frame))
    assert {d.name: d for d in load_domains(back)} == {d.name: d for d in shipped_domains()}
    change = taxonomy_frame(spark, [Domain("salud", ("Una",)), Domain("vias", ("Hueco",), ("hueco",))])
    merged = {d.name: d.categories for d in load_domains(upsert_taxonomy(frame, change))}
    assert merged["salud"] == ("Una",) and merged["vias"] == ("Hueco",) and len(merged) == 4
    assert [d.name for d in load_domains(frame, only="ruido")] == ["ruido"]


def test_late_column(spark):
    old = spark.createDataFrame([("a", "1", None, False)], "domain string, case_id string, category string, processed boolean")
    assert add_missing_columns(old, STATUS).head().method is None


def test_export_round_trip(spark, tmp_path, make_cases):
    cases = make_cases(("1", 'a "q" »x\ny', "2026-03-01"), ("2", None, "2026-03-02"))
    out = str(tmp_path / "out")
    write_delimited(cases, out)
    back = read_export(spark, out)
    assert as_set(back, "case_id", "subject", "entry_date") == as_set(cases, "case_id", "subject", "entry_date")


def test_stored_keys_are_not_exchanged(spark, tmp_path, make_cases):
    """The key table is read bucket by bucket; only the batch's keys move."""
    store = Store(spark, str(tmp_path / "store's"))
    with stored_keys(store) as none:
        assert none.count() == 0
    for part in (["a", "b"], ["c"]):
        rows = make_cases(*[(k,) for k in part])
        store.commit(append={KEYS: write_keys(store, rows, 6)})
    assert key_buckets(store) == 6
    batch = make_cases(("a", "x", "1"), ("d", "later", "2"), ("d", "first", "1"), ("e", "y", "1"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with stored_keys(store) as known:
            assert as_set(known) == {("a",), ("b",), ("c",)}
            wanted = load.new_keys(batch, known, "entry_date", key_buckets(store))
            plan = plan_of(wanted)
            assert as_set(wanted) == {("d", "1"), ("e", "1")}
            wanted = spark.createDataFrame(wanted.collect(), wanted.schema)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") == 2
    stored_side = plan[plan.rindex("Sort ["):]
    assert "FileScan parquet" in stored_side and "Exchange" not in stored_side
    assert as_set(load.rows_at(batch, wanted, "entry_date"), "subject") == {("first",), ("y",)}
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("casemill_keys")]


def test_rows_of_a_staged_batch_stay_where_they_are(spark, tmp_path, monkeypatch):
    """Only the numbers of the wanted rows move to the buckets of the batch."""
    monkeypatch.setattr(load, "CHUNK_BITS", 8)
    store = Store(spark, str(tmp_path / "store"))
    batch = load.numbered(spark.range(5_000).selectExpr("id", "repeat('text ', 20) AS subject"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with store.bucketed("staging", batch, load.CHUNK, 6) as (rows, in_chunks):
            assert rows.select(load.CHUNK).distinct().count() > 8
            wanted = store.staged("wanted", rows.filter("id % 7 = 0").select(load.ROW))
            with rows_stay_dealt(spark):
                found = load.rows_numbered(in_chunks, wanted, 6)
                plan = plan_of(found)
                assert as_set(found, "id") == {(i,) for i in range(0, 5_000, 7)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Bucketed: true" in plan and plan.count("Exchange") == 1
    assert "subject" not in plan[plan.index("Exchange"):]
    assert not list((tmp_path / "store" / "staging").iterdir())
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("casemill_staging")]
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"


def test_headers_of_many_files_take_one_job(spark, tmp_path):
    folder = tmp_path / "many files"
    folder.mkdir()
    for i in range(1000):
        extra = "»Otro" if i % 2 else ""
        (folder / f"part {i}.csv").write_text(f"Número petición»Asunto{extra}\n{i}»t»z\n", "utf-8")
    (folder / "quoted.csv").write_text('﻿"Número petición"»"Asunto ""x"" » y"\nq»t\n', "utf-8")
    (folder / "wrapped.csv").write_text('Número petición»"Asunto\nlargo"\nw»t\n', "utf-8")
    (folder / "empty.csv").write_text("", "utf-8")
    tracker = spark.sparkContext.statusTracker()

    def jobs(paths):
        spark.sparkContext.setJobGroup(f"headers-{len(paths)}", "")
        found = read_headers(spark, paths)
        return found, len(tracker.getJobIdsForGroup(f"headers-{len(paths)}"))

    plain = sorted(str(p) for p in folder.glob("part *"))
    try:
        (many, n_many), (few, n_few) = jobs(plain), jobs(plain[:3])
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert len(many) == 1000 and len(few) == 3 and n_many <= n_few + 1
    assert {tuple(n) for n in many.values()} == {
        ("numero_peticion", "asunto"), ("numero_peticion", "asunto", "otro")
    }
    named = {k.rpartition("/")[2]: v for k, v in read_headers(spark, str(folder)).items()}
    assert len(named) == 1002
    assert named["quoted.csv"] == ["numero_peticion", 'asunto_"x"_»_y']
    assert named["wrapped.csv"] == ["numero_peticion", "asunto\nlargo"]
    rows = read_export(spark, str(folder))
    assert rows.count() == 1002 and rows.filter("otro = 'z'").count() == 500


def test_written_exports_keep_white_space(spark, tmp_path):
    texts = ["  a  ", 'say "x"', "two\nlines", "with » inside", "tab\t", ""]
    rows = spark.createDataFrame(list(enumerate(texts)), "a long, b string")
    write_delimited(rows, str(tmp_path / "out"))
    back = read_export(spark, str(tmp_path / "out"))
    assert as_set(back, "b") == {(t or None,) for t in texts}
