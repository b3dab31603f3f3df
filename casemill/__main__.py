"""Command line: one sub-command per job."""

from __future__ import annotations

import argparse
import time
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill import fixed_values as fixed
from casemill.operators import evaluation, reports
from casemill.operators.engines import TermRules
from casemill.operators.lifecycle import export_period
from casemill.operators.sampling import stratified_sample
from casemill.operators.taxonomy import Domain, load_domains, shipped_domains
from casemill.plans import cycle
from casemill.session import build_session
from casemill.sources.delimited import write_delimited, write_rows
from casemill.sources.store import Store

SAMPLE_COLUMNS = ["case_id", "domain", "original_category", "original_method", "subject"]
# The columns of the published rows, in their order.
RESULT_COLUMNS = [
    "case_id", "domain", "original_category", "original_method", "predicted", "match",
    "confidence", "margin", "latency_s", "subject",
]


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="casemill")
    jobs = parser.add_subparsers(dest="job", required=True)
    for name, text in [
        ("run", "load changed exports, classify, snapshot"),
        ("classify", "classify pending rows"),
        ("metrics", "all metrics"),
        ("shares", "monthly shares by entry and register date"),
        ("monthly", "monthly export with totals"),
        ("progress", "progress of some periods"),
        ("export", "cases of some periods"),
        ("reset", "make the periods' rows pending again"),
        ("purge", "drop the periods' cases and status rows"),
        ("register", "add or replace domains and seed the cases that lack a status row"),
        ("sample", "draw the stratified sample"),
        ("evaluate", "measure an engine on the stratified sample"),
        ("compact", "write the small folders of the tables together"),
        ("difference", "cases or status rows that changed since a tagged state"),
    ]:
        job = jobs.add_parser(name, help=text)
        job.add_argument("--store", required=True, help="root folder of the tables")
        job.add_argument("--taxonomy", help="Parquet folder; the shipped domains if absent")
        job.add_argument("--domain", help="one domain only")
        job.add_argument("--period", action="append", default=[], help="date prefix, repeatable")
        job.add_argument("--out", help="output folder")
        job.add_argument("--engine", help="module:attribute of an engine; term rules if absent")
        job.add_argument("--source", help="folder of exports")
        job.add_argument("--snapshots", help="root folder of snapshots")
        job.add_argument("--force", "-f", action="store_true", help="also unchanged exports")
        job.add_argument("--splittable", action="store_true", help="no line breaks inside fields")
        job.add_argument("--keyword-filter", action="store_true")
        job.add_argument("--seed", type=int, default=0)
        job.add_argument("--since", help="tag of the earlier state")
        job.add_argument("--until", help="tag of the later state; the latest if absent")
    args = parser.parse_args(argv)
    needs = {
        "run": ["source"], "progress": ["period"], "export": ["period", "out"],
        "reset": ["period"], "purge": ["period"], "sample": ["out"], "evaluate": ["out"],
        "difference": ["since", "out"],
    }
    missing = [f"--{n}" for n in needs.get(args.job, []) if not getattr(args, n)]
    if missing:
        parser.error(f"{args.job} needs {', '.join(missing)}")
    return args


def configured_domains(
    spark: SparkSession, args: argparse.Namespace, store: Store
) -> list[Domain]:
    """The given taxonomy, else the one registered in the store, else the shipped one."""
    if args.taxonomy:
        return load_domains(spark.read.parquet(args.taxonomy))
    return cycle.registered_domains(store) or shipped_domains()


def chosen_domains(domains: list[Domain], name: str | None) -> list[Domain]:
    chosen = [d for d in domains if name in (None, d.name)]
    if not chosen:
        raise SystemExit(f"no domain named {name!r}")
    return chosen


def configured_engine(args: argparse.Namespace, closed: bool = False):
    if not args.engine:
        return TermRules({}, closed=closed)
    module, _, attribute = args.engine.partition(":")
    return getattr(import_module(module), attribute)


def emit(report: DataFrame, args: argparse.Namespace, name: str) -> None:
    """A report's rows are months, domains or categories: one file, or the console."""
    if args.out:
        write_delimited(report, f"{args.out}/{name}", separator=",", single_file=True)
    else:
        print(" | ".join(report.columns))
        for row in report.toLocalIterator():
            print(" | ".join("" if value is None else str(value) for value in row))


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parse(argv)
    spark = spark or build_session()
    store = Store(spark, args.store)
    domains = configured_domains(spark, args, store)
    chosen = chosen_domains(domains, args.domain)
    named = [args.domain] if args.domain else None

    if args.job == "run":
        print(
            cycle.run_cycle(
                spark,
                args.source,
                args.store,
                domains,
                configured_engine(args),
                snapshot_root=args.snapshots,
                force=args.force,
                multiline=not args.splittable,
                keyword_filter=args.keyword_filter,
                only=named,
            )
        )
        return
    if args.job == "register":
        cycle.replace_domains(store, chosen)
        return
    if args.job == "classify":
        print(cycle.classify_store(store, chosen, configured_engine(args), args.keyword_filter))
        return
    if args.job == "reset":
        cycle.reset_store(store, args.period, named)
        return
    if args.job == "purge":
        cycle.purge_store(store, args.period, named)
        return

    if args.job == "compact":
        print(cycle.compact_store(store))
        return
    if args.job == "difference":
        cases, status = cycle.tagged_difference(store, args.since, args.until)
        write_delimited(cases, f"{args.out}/cases", separator=",")
        write_delimited(status, f"{args.out}/status", separator=",")
        return

    cases, status = cycle.read_cases(store).drop(cycle.LOAD), cycle.read_status(store)
    if args.domain:
        status = status.filter(status.domain == args.domain)
    if args.job == "metrics":
        emit(reports.metrics_report(cases, status), args, "metrics")
    elif args.job == "shares":
        for date, blank in (("entry_date", False), ("register_date", True)):
            emit(reports.domain_share_by_month(status, cases, date, blank), args, date)
    elif args.job == "monthly":
        report = reports.domain_monthly_export(status, cases)
        emit(reports.as_text(report, percents=["classified_pct"]), args, "monthly")
    elif args.job == "progress":
        matrix = reports.progress_matrix(status, cases, args.period)
        emit(reports.progress_summary(matrix), args, "progress")
    elif args.job == "export":
        write_delimited(export_period(cases, args.period), args.out)
    else:
        # Staged first: the files below are written by one task each, which reads the few drawn
        # rows and not the texts of all cases.
        sample = store.staged(
            "samples", stratified_sample(status, cases, fixed.SAMPLE_QUOTAS, args.seed)
        )
        if args.job == "sample":
            write_rows(sample.coalesce(1), args.out, SAMPLE_COLUMNS)
            return
        engine = configured_engine(args, closed=True)
        started = time.perf_counter()
        rows = evaluation.evaluate(sample, chosen, engine, with_text=True)
        evaluated = store.staged("evaluations", rows)
        seconds = time.perf_counter() - started
        write_rows(evaluation.result_rows(evaluated).coalesce(1), args.out, RESULT_COLUMNS)
        emit(evaluation.agreement_global(evaluated), args, "agreement")
        emit(evaluation.agreement_by_domain(evaluated), args, "agreement_by_domain")
        emit(evaluation.agreement_by_category(evaluated), args, "agreement_by_category")
        emit(evaluation.confusion_matrix(evaluated), args, "confusion")
        emit(evaluation.throughput(evaluated, seconds), args, "throughput")
        nested = evaluation.predicted_distribution(evaluated)
        emit(nested.withColumn("predicted", F.to_json("predicted")), args, "distribution")
        shown = evaluation.top_disagreements(evaluated).drop("probabilities")
        emit(shown.withColumn("top3", F.to_json("top3")), args, "disagreements")


if __name__ == "__main__":
    main()
