from conftest import as_set, plan_of
from pyspark.sql import functions as F

from casemill.operators import lifecycle, reports
from casemill.operators.status import seed_status

CASES = [
    ("1", "noise", "2026-03-15", "2026-04-01"),
    ("2", None, "2026-03-20", None),
    ("3", " ", "2026-04-02", "2026-04-03"),
    ("4", "x", "2026", ""),
    ("5", "y", None, "2026-03-09"),
    ("6", "z", "", "2025-12-31"),
]
STATUS = [
    ("a", "1", "X", True, "IA"),
    ("a", "2", None, True, "VACIO"),
    ("a", "3", "Y", True, "IA"),
    ("a", "4", "X", True, "IA"),
    ("a", "5", None, False, None),
    ("a", "orphan", "X", True, "IA"),
    ("b", "1", None, True, "KEYWORDS"),
    ("b", "6", "Z", True, "IA"),
]


def ordered(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_cases_per_month(make_cases):
    report = reports.cases_per_month(make_cases(*CASES))
    assert ordered(report, "month", "total") == [
        ("2026", 1), ("2026-03", 2), ("2026-04", 1), ("Sin fecha", 2),
    ]


def test_subject_coverage(make_cases):
    cases = make_cases(*CASES)
    assert as_set(reports.subject_coverage(cases), "metric", "total") == {
        ("with_subject", 4), ("without_subject", 2), ("total", 6),
    }
    empty = reports.subject_coverage(cases.filter("false"))
    assert as_set(empty, "metric", "total", "pct") == {
        ("with_subject", 0, 0.0), ("without_subject", 0, 0.0), ("total", 0, 100.0),
    }


def test_totals_and_breakdown(make_status):
    status = make_status(*STATUS)
    totals = {r.domain: r for r in reports.domain_totals(status).collect()}
    assert (totals["a"].classified, totals["a"].unclassified, totals["a"].total) == (4, 2, 6)
    assert (totals["a"].processed, totals["a"].pending) == (5, 1)
    breakdown = ordered(reports.category_breakdown(status), "domain", "category", "total", "share_pct")
    assert breakdown == [("a", "X", 3, 75.0), ("a", "Y", 1, 25.0), ("b", "Z", 1, 100.0)]
    sums = reports.category_breakdown(status).groupBy("domain").agg(F.sum("total").alias("n"))
    assert as_set(sums) == {(d, r.classified) for d, r in totals.items()}
    assert as_set(reports.pending_per_domain(status)) == {("a", 1), ("b", 0)}
    assert as_set(reports.method_audit(status), "domain", "method", "total") == {
        ("a", "IA", 4), ("a", "VACIO", 1), ("a", None, 1), ("b", "IA", 1), ("b", "KEYWORDS", 1),
    }


def test_month_shares(make_cases, make_status):
    cases, status = make_cases(*CASES), make_status(*STATUS)
    by_entry = reports.domain_share_by_month(status, cases, "entry_date").filter("domain = 'a'")
    assert ordered(by_entry, "month", "total", "classified", "classified_pct") == [
        ("2026-04", 1, 1, 100.0),
        ("2026-03", 2, 1, 50.0),
        ("2026", 1, 1, 100.0),
        ("Sin fecha", 1, 0, 0.0),
    ]
    by_register = reports.domain_share_by_month(status, cases, "register_date", with_blank=True)
    rows = {(r.domain, r.month): r for r in by_register.collect()}
    assert (rows["a", "2026-04"].total, rows["a", "2026-04"].without_subject) == (2, 1)
    assert rows["a", "Sin fecha"].without_subject_pct == 50.0
    joined = status.join(cases, "case_id", "left_semi").count()
    assert by_register.agg(F.sum("total")).head()[0] == joined


def test_monthly_export(make_cases, make_status):
    report = reports.domain_monthly_export(make_status(*STATUS), make_cases(*CASES), "a")
    assert ordered(report, "year_month", "year", "month", "classified", "total") == [
        ("2026-03", "2026", "03", 1, 2),
        ("2026-04", "2026", "04", 1, 1),
        (None, None, None, 2, 3),
    ]
    text = reports.as_text(report, ["total"], ["classified_pct"])
    assert ordered(text, "classified_pct")[0] == ("50.0000%",)


def test_progress(make_cases, make_status):
    matrix = reports.progress_matrix(make_status(*STATUS), make_cases(*CASES), ["2026-03"])
    assert as_set(matrix) == {
        ("a", True, True, 1), ("a", True, False, 1), ("a", False, False, 1), ("b", True, False, 1),
    }
    summary = {r.domain: r for r in reports.progress_summary(matrix).collect()}
    assert tuple(summary["a"]) == ("a", 3, 2, 1, 1, 1)


def test_full_report_agrees_with_its_sections(make_cases, make_status):
    cases, status = make_cases(*CASES), make_status(*STATUS)
    report = reports.metrics_report(cases, status)
    section = lambda s: as_set(report.filter(F.col("section") == s), "domain", "label", "total", "pct")
    assert section("subject") == {(None, *r) for r in as_set(reports.subject_coverage(cases))}
    assert section("month") == {(None, *r, None) for r in as_set(reports.cases_per_month(cases))}
    assert section("category") == as_set(reports.category_breakdown(status))
    totals = reports.domain_totals(status).collect()
    assert section("domain") >= {(r.domain, "classified", r.classified, r.classified_pct) for r in totals}


def test_full_report_scans_each_table_once(spark, tmp_path, make_cases, make_status):
    make_cases(*CASES).write.parquet(str(tmp_path / "c"))
    make_status(*STATUS).write.parquet(str(tmp_path / "s"))
    report = reports.metrics_report(
        spark.read.parquet(str(tmp_path / "c")), spark.read.parquet(str(tmp_path / "s"))
    )
    report.collect()
    final = plan_of(report).split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 2 and "ReusedExchange" in final


def test_reset_and_purge(make_cases, make_status):
    cases, status = make_cases(*CASES), make_status(*STATUS)
    march = ["2026-03"]  # cases 1, 2 and 5
    reset = lifecycle.reset_status(status, cases, march)
    assert as_set(reset.filter("NOT processed"), "domain", "case_id", "category", "method") == {
        ("a", "1", None, None), ("a", "2", None, None), ("a", "5", None, None), ("b", "1", None, None),
    }
    assert reset.count() == len(STATUS)
    kept = lifecycle.reset_status(status, cases, march, ["a"], keep_method=True)
    assert as_set(kept.filter("case_id = '1'")) == {
        ("a", "1", None, False, "IA"), ("b", "1", None, True, "KEYWORDS"),
    }
    assert as_set(lifecycle.purge_cases(cases, march), "case_id") == {("3",), ("4",), ("6",)}
    assert as_set(lifecycle.purge_status(status, cases, march), "domain", "case_id") == {
        ("a", "3"), ("a", "4"), ("a", "orphan"), ("b", "6"),
    }
    assert lifecycle.purge_status(status, cases, march, ["b"]).filter("domain = 'a'").count() == 6


def test_export_is_sorted_and_pushed_down(spark, tmp_path, make_cases):
    make_cases(*CASES).write.parquet(str(tmp_path / "c"))
    cases = spark.read.parquet(str(tmp_path / "c"))
    export = lifecycle.export_period(cases, ["2026-03", "2025-12"])
    assert [r.entry_date for r in export.collect()] == ["", "2026-03-15", "2026-03-20", None]
    assert "StringStartsWith(entry_date" in plan_of(export)


def test_bucketed_tables_join_without_shuffle(spark, make_cases, make_status):
    from casemill.sources.store import write_bucketed

    spark.sql("DROP TABLE IF EXISTS b_cases")
    spark.sql("DROP TABLE IF EXISTS b_status")
    cases = make_cases(*CASES)
    write_bucketed(cases, "b_cases", 4)
    write_bucketed(seed_status(cases, ["a", "b"]), "b_status", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("b_status").join(spark.table("b_cases"), "case_id")
        assert joined.count() == 12
        assert "Exchange hashpartitioning(case_id" not in plan_of(joined)
        matrix = reports.progress_matrix(spark.table("b_status"), spark.table("b_cases"), ["2026"])
        assert "hashpartitioning(case_id" not in plan_of(matrix)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
