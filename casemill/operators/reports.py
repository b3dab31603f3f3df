"""Month, category, progress and audit reports (A1..A11, W2, P4).

All groupings are by month, domain or category, so partial aggregation shrinks each map task to a
handful of rows before the shuffle, whatever the skew. Joins carry keys, months and flags only.
Numbers stay numeric; the ``*_text`` helpers render them at the sink.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casemill.functions.dates import NO_DATE, month_label, month_of
from casemill.functions.numbers import percent, percent_text, thousands
from casemill.functions.text import has_text, is_blank
from casemill.operators.lifecycle import cases_in_periods

CLASSIFIED = "classified"


def _has_category() -> Column:
    return F.col("category").isNotNull()


def cases_per_month(cases: DataFrame, date: str = "entry_date") -> DataFrame:
    """A1: cases per month, the missing month last."""
    return (
        cases.groupBy(month_label(F.col(date)).alias("month"))
        .agg(F.count("*").alias("total"))
        .orderBy("month")
    )


def subject_coverage(cases: DataFrame) -> DataFrame:
    """A2: rows ``with_subject``, ``without_subject``, ``total`` with count and percentage."""
    counts = cases.agg(
        F.count_if(has_text(F.col("subject"))).alias("filled"), F.count("*").alias("total")
    )
    return _coverage_rows(counts)


def _coverage_rows(counts: DataFrame) -> DataFrame:
    whole = F.col("total")
    blank = whole - F.col("filled")

    def row(label: str, n: Column, pct: Column) -> Column:
        return F.struct(F.lit(label).alias("metric"), n.alias("total"), pct.alias("pct"))

    rows = F.array(
        row("with_subject", F.col("filled"), percent(F.col("filled"), whole)),
        row("without_subject", blank, percent(blank, whole)),
        row("total", whole, F.lit(100.0)),
    )
    return counts.select(F.inline(rows))


def domain_totals(status: DataFrame) -> DataFrame:
    """A3: per domain classified, unclassified, processed and pending, in one pass.

    ``unclassified`` mixes negative and pending rows; ``pending`` tells them apart.
    """
    counts = status.groupBy("domain").agg(
        F.count(F.when(_has_category(), 1)).alias(CLASSIFIED),
        F.count_if("processed").alias("processed"),
        F.count("*").alias("total"),
    )
    return _with_total_shares(counts)


def _with_total_shares(counts: DataFrame) -> DataFrame:
    total, classified = F.col("total"), F.col(CLASSIFIED)
    return counts.select(
        "domain",
        CLASSIFIED,
        (total - classified).alias("unclassified"),
        "total",
        "processed",
        (total - F.col("processed")).alias("pending"),
        percent(classified, total).alias("classified_pct"),
        percent(total - classified, total).alias("unclassified_pct"),
    ).orderBy("domain")


def category_breakdown(status: DataFrame) -> DataFrame:
    """A4 + W2 + O2: per domain the categories, largest first, with their share."""
    counts = (
        status.filter(_has_category()).groupBy("domain", "category").agg(F.count("*").alias("total"))
    )
    return _with_category_shares(counts)


def _with_category_shares(counts: DataFrame) -> DataFrame:
    whole = F.sum("total").over(Window.partitionBy("domain"))
    return counts.withColumn("share_pct", percent(F.col("total"), whole)).orderBy(
        "domain", F.col("total").desc(), "category"
    )


def pending_per_domain(status: DataFrame) -> DataFrame:
    """A10."""
    return status.groupBy("domain").agg(F.count_if(~F.col("processed")).alias("pending"))


def method_audit(status: DataFrame) -> DataFrame:
    """Where results came from; a NULL method is a row that nobody finished."""
    return (
        status.groupBy("domain", "method")
        .agg(F.count("*").alias("total"), F.count("category").alias(CLASSIFIED))
        .orderBy("domain", F.col("method").asc_nulls_last())
    )


def domain_share_by_month(
    status: DataFrame, cases: DataFrame, date: str, with_blank: bool = False
) -> DataFrame:
    """A5 (``entry_date``) and A6 (``register_date``, ``with_blank=True``), newest month first.

    Status rows without a case drop out, as in any report that needs a date.
    """
    facts = [month_label(F.col(date)).alias("month")]
    if with_blank:
        facts.append(is_blank(F.col("subject")).alias("blank"))
    joined = status.select("domain", "case_id", _has_category().alias("hit")).join(
        cases.select("case_id", *facts), "case_id"
    )
    counts = [F.count("*").alias("total"), F.count_if("hit").alias(CLASSIFIED)]
    if with_blank:
        counts.append(F.count_if("blank").alias("without_subject"))
    report = joined.groupBy("domain", "month").agg(*counts)
    report = report.withColumn("classified_pct", percent(F.col(CLASSIFIED), F.col("total")))
    if with_blank:
        report = report.withColumn(
            "without_subject_pct", percent(F.col("without_subject"), F.col("total"))
        )
    dated_first = (F.col("month") != NO_DATE).desc()
    return report.orderBy("domain", dated_first, F.col("month").desc())


def domain_monthly_export(
    status: DataFrame, cases: DataFrame, domain: str | None = None
) -> DataFrame:
    """Per domain and entry month; the row with a NULL month is the domain's grand total.

    Missing and malformed months (shorter than ``YYYY-MM``) are left out, also of the total.
    """
    if domain is not None:
        status = status.filter(F.col("domain") == domain)
    dated = cases.filter(has_text(F.col("entry_date"))).select(
        "case_id", month_of(F.col("entry_date")).alias("year_month")
    )
    dated = dated.filter(F.length("year_month") >= 7)
    monthly = (
        status.select("domain", "case_id", _has_category().alias("hit"))
        .join(dated, "case_id")
        .groupBy("domain", "year_month")
        .agg(F.count_if("hit").alias(CLASSIFIED), F.count("*").alias("total"))
    )
    return (
        monthly.groupingSets([["domain", "year_month"], ["domain"]], "domain", "year_month")
        .agg(F.sum(CLASSIFIED).alias(CLASSIFIED), F.sum("total").alias("total"))
        .select(
            "domain",
            "year_month",
            F.substring("year_month", 1, 4).alias("year"),
            F.substring("year_month", 6, 2).alias("month"),
            CLASSIFIED,
            "total",
            percent(F.col(CLASSIFIED), F.col("total")).alias("classified_pct"),
        )
        .orderBy("domain", F.col("year_month").asc_nulls_last())
    )


def progress_matrix(status: DataFrame, cases: DataFrame, prefixes: Sequence[str]) -> DataFrame:
    """Status counts of the cases of some periods, by processed and has_category."""
    chosen = cases_in_periods(cases, prefixes).select("case_id")
    return (
        status.select("domain", "case_id", "processed", _has_category().alias("has_category"))
        .join(chosen, "case_id")
        .groupBy("domain", "processed", "has_category")
        .agg(F.count("*").alias("total"))
        .orderBy("domain", "processed", "has_category")
    )


def progress_summary(matrix: DataFrame) -> DataFrame:
    """One row per domain out of the matrix of A8."""

    def sum_if(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("total"))), F.lit(0))

    done = F.col("processed")
    return (
        matrix.groupBy("domain")
        .agg(
            F.sum("total").alias("total"),
            sum_if(done).alias("processed"),
            sum_if(done & F.col("has_category")).alias("positive"),
            sum_if(done & ~F.col("has_category")).alias("negative"),
            sum_if(~done).alias("pending"),
        )
        .orderBy("domain")
    )


def metrics_report(cases: DataFrame, status: DataFrame) -> DataFrame:
    """Sections A1 to A4 as rows ``section, domain, label, total, pct``.

    ``cases`` and ``status`` are each grouped once; the sections are roll-ups of those two small
    groupings, whose shuffles Spark reuses.
    """
    case_groups = cases.groupBy(
        month_label(F.col("entry_date")).alias("month"),
        has_text(F.col("subject")).alias("filled"),
    ).agg(F.count("*").alias("n"))
    status_groups = status.groupBy("domain", "category", "processed").agg(F.count("*").alias("n"))

    months = case_groups.groupBy("month").agg(F.sum("n").alias("total"))
    coverage = _coverage_rows(
        case_groups.agg(
            F.coalesce(F.sum(F.when(F.col("filled"), F.col("n"))), F.lit(0)).alias("filled"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        )
    )
    totals = _with_total_shares(
        status_groups.groupBy("domain").agg(
            F.coalesce(F.sum(F.when(_has_category(), F.col("n"))), F.lit(0)).alias(CLASSIFIED),
            F.coalesce(F.sum(F.when(F.col("processed"), F.col("n"))), F.lit(0)).alias("processed"),
            F.sum("n").alias("total"),
        )
    )
    # Keeping rows by an aggregate, not by the grouping key, leaves the scan as it is, so that
    # the totals and the breakdown share one scan of the status rows.
    breakdown = _with_category_shares(
        status_groups.groupBy("domain", "category")
        .agg(F.sum("n").alias("total"), F.count("category").alias("known"))
        .filter("known > 0")
        .drop("known")
    )

    def section(name: str, df: DataFrame, domain: Column, label: Column, pct: Column) -> DataFrame:
        return df.select(
            F.lit(name).alias("section"),
            domain.alias("domain"),
            label.alias("label"),
            F.col("total"),
            pct.cast("double").alias("pct"),
        )

    nothing = F.lit(None).cast("string")
    states = totals.select(
        "domain",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(n).alias("label"), F.col(n).alias("total"), pct.alias("pct"))
                    for n, pct in [
                        (CLASSIFIED, F.col("classified_pct")),
                        ("unclassified", F.col("unclassified_pct")),
                        ("total", F.lit(None).cast("double")),
                        ("processed", F.lit(None).cast("double")),
                        ("pending", F.lit(None).cast("double")),
                    ]
                ]
            )
        ),
    )
    return (
        section("subject", coverage, nothing, F.col("metric"), F.col("pct"))
        .unionByName(section("month", months, nothing, F.col("month"), F.lit(None)))
        .unionByName(section("domain", states, F.col("domain"), F.col("label"), F.col("pct")))
        .unionByName(
            section(
                "category", breakdown, F.col("domain"), F.col("category"), F.col("share_pct")
            )
        )
    )


def as_text(
    report: DataFrame, counts: Sequence[str] = (), percents: Sequence[str] = (), decimals: int = 4
) -> DataFrame:
    """A report with counts and percentages as published text."""
    return report.withColumns(
        {
            **{c: thousands(F.col(c)) for c in counts},
            **{c: percent_text(F.col(c), decimals) for c in percents},
        }
    )
