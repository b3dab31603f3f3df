"""Every operator as a query over the benchmark tables (see ``bindings``)."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.fixed_values import CHOICE_CHARS, NOT_APPLICABLE, PROMPT_CHARS
from casemill.functions.dates import months_of_year
from casemill.functions.text import clip, has_text
from casemill.operators import cascade, criteria, evaluation, lifecycle, load, reports, status
from casemill.operators.answers import normalise_choice, normalise_generated
from casemill.operators.engines import CallableEngine, TextModel
from casemill.operators.sampling import stratified_sample
from casemill.operators.taxonomy import dump_taxonomy, parse_taxonomy, upsert_taxonomy
from casemill.plans import bindings as b
from casemill.schema import STATUS, add_missing_columns

Query = Callable[[SparkSession, str], DataFrame]

MONTH = ["1997-03"]
MONTHS = months_of_year(1998, 3, 10)
QUOTAS = {
    ("licence", "GNU General Public License"): 5,
    ("licence", "MIT License"): 5,
    ("licence", "Apache License"): 5,
    ("contact", "Email"): 4,
    ("contact", "Phone"): 4,
    ("abusive_words", "Insult"): 12,
    ("abusive_words", "Contempt"): 12,
    ("language", "English"): 35,
    ("language", "German"): 35,
    ("language", "Spanish"): 23,
    ("language", "French"): 47,
}
SEED = 7


# --- load -------------------------------------------------------------------------------------


def _line_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The export of one row per order line: a case number comes several times."""
    return b.table(spark, sf_dir, "lineitem").withColumn(
        "case_id", F.col("l_orderkey").cast("string")
    )


LINE_ORDER = ["l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity",
              "l_extendedprice", "l_discount", "l_tax"]


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases already in the master table: the closed orders."""
    return b.cases(spark, sf_dir, subject=False, register_date=False).filter("order_status = 'F'")


def _mixed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines, and orders numbered by their document; most orders have none."""
    orders = b.table(spark, sf_dir, "orders")
    documents = b.table(spark, sf_dir, "documents").select("doc_id", "text")
    numbered = orders.join(documents, orders.o_orderkey == documents.doc_id, "left").select(
        F.col("doc_id").cast("string").alias("case_id"),
        F.col("o_orderkey").cast("string").alias("origin"),
        F.col("text").alias("subject"),
    )
    lines = _line_rows(spark, sf_dir).select(
        "case_id",
        F.concat_ws("/", "case_id", F.col("l_linenumber").cast("string")).alias("origin"),
        F.lit(None).cast("string").alias("subject"),
    )
    return numbered.unionByName(lines)


def load_insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    fresh = load.new_rows(
        _line_rows(spark, sf_dir), _stored(spark, sf_dir), [F.col(c) for c in LINE_ORDER]
    )
    return fresh.select(
        "case_id", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        F.col("l_shipdate").cast("string").alias("entry_date"),
    )


def load_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load.load_accounting(
        load.tag_rejects(_mixed_rows(spark, sf_dir)), _stored(spark, sf_dir)
    )


def load_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load.rejected(load.tag_rejects(_mixed_rows(spark, sf_dir)))
    return rows.select("origin", load.REASON)


# --- domains ----------------------------------------------------------------------------------


def seed_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = b.cases(spark, sf_dir, subject=False, register_date=False)
    return status.seed_status(keys, b.DOMAIN_NAMES)


def _partial_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed orders know three domains, partly shipped ones a single domain, open ones none."""
    keys = b.cases(spark, sf_dir, subject=False, register_date=False)
    closed = status.seed_status(keys.filter("order_status = 'F'"), b.DOMAIN_NAMES[:3])
    partly = status.seed_status(keys.filter("order_status = 'P'"), b.DOMAIN_NAMES[:1])
    return closed.unionByName(partly)


def sync_missing_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = b.cases(spark, sf_dir, subject=False, register_date=False)
    return status.missing_status(keys, _partial_status(spark, sf_dir), b.DOMAIN_NAMES)


def taxonomy_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored: a domain per document source, its languages. New: sources with labels, their labels."""
    documents = b.table(spark, sf_dir, "documents")

    def observed(rows: DataFrame, category: str, keyword: str) -> DataFrame:
        return rows.groupBy(F.col("source").alias("domain")).agg(
            F.array_sort(F.collect_set(category)).alias("categories"),
            F.array_sort(F.collect_set(keyword)).alias("keywords"),
        )

    graded = (
        b.table(spark, sf_dir, "labels")
        .join(documents, "doc_id")
        .withColumn("grade", F.concat(F.lit("quality "), F.col("quality").cast("string")))
    )
    merged = upsert_taxonomy(
        observed(documents, "lang", "lang"), observed(graded, "grade", "lang")
    )
    texts = dump_taxonomy(merged.withColumn("prompt_template", F.lit(None).cast("string")))
    return parse_taxonomy(texts).select(
        "domain",
        F.array_join("categories", "|").alias("categories"),
        F.array_join("keywords", "|").alias("keywords"),
    )


def taxonomy_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A domain per document source with its languages as stored JSON text."""
    documents = b.table(spark, sf_dir, "documents")
    languages = F.array_sort(F.collect_set("lang"))
    observed = documents.groupBy(F.col("source").alias("domain")).agg(
        languages.alias("categories"), languages.alias("keywords")
    )
    return dump_taxonomy(observed.withColumn("prompt_template", F.lit(None).cast("string"))).drop(
        "prompt_template"
    )


def late_method_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status rows written before the method was kept, read with today's columns."""
    return add_missing_columns(b.status(spark, sf_dir).drop("method"), STATUS)


def orphan_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A purge of two domains only leaves status rows of the others without a case."""
    cases = b.cases(spark, sf_dir, subject=False)
    kept = lifecycle.purge_status(
        status.seed_status(cases, b.DOMAIN_NAMES), cases, MONTHS, b.DOMAIN_NAMES[:2]
    )
    return status.orphan_count(kept, lifecycle.purge_cases(cases, MONTHS))


# --- reports ----------------------------------------------------------------------------------


def cases_per_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.cases_per_month(b.cases(spark, sf_dir, subject=False, register_date=False))


def cases_per_register_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.cases_per_month(b.cases(spark, sf_dir, subject=False), "register_date")


def subject_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.subject_coverage(b.texts_of(spark, sf_dir))


def domain_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.domain_totals(b.status(spark, sf_dir))


def category_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.category_breakdown(b.status(spark, sf_dir))


def pending_per_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.pending_per_domain(b.status(spark, sf_dir))


def method_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.method_audit(b.status(spark, sf_dir, keyword_filter=True))


def domain_share_by_entry_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = b.cases(spark, sf_dir, subject=False, register_date=False)
    return reports.domain_share_by_month(b.status(spark, sf_dir), cases, "entry_date")


def domain_share_by_register_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.domain_share_by_month(
        b.status(spark, sf_dir), b.cases(spark, sf_dir), "register_date", with_blank=True
    )


def domain_monthly_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = b.cases(spark, sf_dir, subject=False, register_date=False)
    return reports.domain_monthly_export(b.status(spark, sf_dir), cases)


def domain_monthly_export_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.as_text(
        domain_monthly_export(spark, sf_dir), [reports.CLASSIFIED, "total"], ["classified_pct"]
    )


def progress_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = b.cases(spark, sf_dir, subject=False)
    return reports.progress_matrix(b.status(spark, sf_dir), cases, MONTH)


def progress_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.progress_summary(progress_matrix(spark, sf_dir))


def metrics_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.metrics_report(b.texts_of(spark, sf_dir), b.status(spark, sf_dir))


# --- cascade ----------------------------------------------------------------------------------


def mark_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cascade.mark_blank(b.status(spark, sf_dir), b.texts_of(spark, sf_dir))


def mark_no_keyword(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cascade.mark_no_keyword(b.status(spark, sf_dir), b.texts_of(spark, sf_dir), b.DOMAINS)


def keyword_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    misses = cascade.keyword_misses(b.texts_of(spark, sf_dir), b.DOMAINS)
    return misses.select("case_id", F.array_join("missed", "|").alias("missed"))


def _all_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every readable case for every domain."""
    readable = b.texts_of(spark, sf_dir).filter(has_text(F.col("subject")))
    domains = F.array(*map(F.lit, b.DOMAIN_NAMES))
    return readable.select("case_id", "subject", F.explode(domains).alias("domain"))


def _requests(spark: SparkSession, sf_dir: str, closed: bool) -> DataFrame:
    requests = criteria.choice_requests(_all_texts(spark, sf_dir), b.DOMAINS, closed)
    lines = F.transform(
        F.map_entries("criteria"), lambda e: F.concat(e["key"], F.lit(": "), e["value"])
    )
    return requests.withColumn("criteria", F.array_join(lines, "\n"))


def choice_criteria(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _requests(spark, sf_dir, closed=False)


def closed_choice_criteria(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _requests(spark, sf_dir, closed=True)


def build_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return criteria.build_prompts(_all_texts(spark, sf_dir), b.DOMAINS)


def engine_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text as each kind of engine can take it, next to its whole length."""
    text = F.col("subject")
    return b.texts_of(spark, sf_dir).select(
        "case_id",
        F.length(text).cast("bigint").alias("n_chars"),
        clip(text, PROMPT_CHARS).alias("prompt_text"),
        clip(text, CHOICE_CHARS).alias("choice_text"),
    )


def classify_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cascade.classify_pending(
        b.status(spark, sf_dir), b.texts_of(spark, sf_dir), b.DOMAINS, b.RULES
    )


def classify_rules_with_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cascade.classify_pending(
        b.status(spark, sf_dir), b.texts_of(spark, sf_dir), b.DOMAINS, b.RULES, keyword_filter=True
    )


def rule_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answer, confidence and margin of the term rules for all waiting texts."""
    waiting = cascade.pending_texts(b.status(spark, sf_dir), b.texts_of(spark, sf_dir))
    return b.RULES.score(waiting, b.DOMAINS).select(
        "case_id", "domain", "answer", "confidence", "margin"
    )


def pending_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O3: the next bounded slice of waiting texts."""
    waiting = cascade.pending_texts(b.status(spark, sf_dir), b.texts_of(spark, sf_dir))
    domains = F.array_join(F.array_sort("domains"), "|")
    return cascade.pending_slice(waiting, 50).withColumn("domains", domains)


def _raw_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents read as the free-text answers of an engine."""
    return _all_texts(spark, sf_dir).select(
        "case_id", "domain", F.concat(F.lit(" Respuesta: "), F.col("subject")).alias("answer")
    )


def normalise_generated_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise_generated(_raw_answers(spark, sf_dir), b.DOMAINS)


def normalise_choice_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = _all_texts(spark, sf_dir).withColumnRenamed("subject", "answer")
    return normalise_choice(answers, b.DOMAINS)


def apply_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Categories found by name in the texts, applied to the pending rows."""
    answers = normalise_choice_answers(spark, sf_dir)
    return cascade.apply_outcomes(b.status(spark, sf_dir), answers, "IA")


def _word_scorer():
    """A factory of a Python scorer that cannot handle tables: those texts fail and stay pending."""
    terms = {
        d.name: [
            (c, [t.lower() for t in b.TERMS.get(d.name, {}).get(c, [c])]) for c in d.categories
        ]
        for d in b.DOMAINS
    }

    def answer(domain: str, text: str) -> str:
        lowered = text.lower()
        for category, words in terms[domain]:
            if any(word in lowered for word in words):
                return category
        return NOT_APPLICABLE

    def predict(batch: pd.DataFrame) -> list[str]:
        if batch["subject"].str.contains("|", regex=False).any():
            raise ValueError("tables are not supported")
        return [answer(d, s) for d, s in zip(batch["domain"], batch["subject"], strict=True)]

    return lambda: predict


def classify_callable(spark: SparkSession, sf_dir: str) -> DataFrame:
    engine = CallableEngine(_word_scorer(), retries=0, batch_rows=50)
    return cascade.classify_in_passes(
        b.status(spark, sf_dir), b.texts_of(spark, sf_dir), b.DOMAINS, engine
    )


def classify_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text model trained on the classified rows answers the pending ones."""
    rows, texts = b.status(spark, sf_dir), b.texts_of(spark, sf_dir)
    trained = TextModel.fit(rows.filter("method = 'IA'"), texts)
    return cascade.classify_in_passes(rows, texts, b.DOMAINS, trained)


# --- lifecycle --------------------------------------------------------------------------------


def reset_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = b.cases(spark, sf_dir, subject=False)
    return lifecycle.reset_status(b.status(spark, sf_dir), cases, MONTH)


def reset_month_keep_method(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = b.cases(spark, sf_dir, subject=False)
    return lifecycle.reset_status(
        b.status(spark, sf_dir), cases, MONTH, b.DOMAIN_NAMES[:2], keep_method=True
    )


def purge_months_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = b.cases(spark, sf_dir, subject=False)
    return lifecycle.purge_status(b.status(spark, sf_dir), cases, MONTHS)


def purge_months_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lifecycle.purge_cases(b.cases(spark, sf_dir), MONTHS)
    return kept.select("case_id", "subject", "entry_date", "register_date")


def export_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle.export_period(b.cases(spark, sf_dir), MONTH)


# --- sample and evaluation --------------------------------------------------------------------


def sample_strata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stratified_sample(
        b.classified(spark, sf_dir), b.texts_of(spark, sf_dir), QUOTAS, SEED
    )


def _evaluated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.evaluate(b.labelled(spark, sf_dir), b.DOMAINS, b.CLOSED_RULES)


def evaluate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.result_rows(_evaluated(spark, sf_dir)).select(
        "case_id", "domain", "original_category", "predicted", "match", "confidence", "margin"
    )


def evaluate_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second, weaker engine on the stratified sample: agreement per stratum."""
    drawn = sample_strata(spark, sf_dir)
    evaluated = evaluation.evaluate(drawn, b.DOMAINS, b.SECOND_RULES)
    return evaluation.agreement_by_category(evaluated)


def agreement_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.agreement_global(_evaluated(spark, sf_dir))


def agreement_by_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.agreement_by_domain(_evaluated(spark, sf_dir)).drop("mean_latency_ms")


def agreement_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.agreement_by_category(_evaluated(spark, sf_dir))


def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.confusion_matrix(_evaluated(spark, sf_dir))


def confusion_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = next(d.categories for d in b.DOMAINS if d.name == "language")
    return evaluation.confusion_wide(_evaluated(spark, sf_dir), "language", labels)


def predicted_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = F.transform(
        F.map_entries("predicted"),
        lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")),
    )
    return evaluation.predicted_distribution(_evaluated(spark, sf_dir)).withColumn(
        "predicted", F.array_join(counts, ", ")
    )


def top_disagreements(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = evaluation.top_disagreements(_evaluated(spark, sf_dir))
    likeliest = F.transform("top3", lambda e: e["key"])
    return shown.select(
        "case_id", "domain", "original_category", "predicted", "confidence",
        F.array_join(likeliest, "|").alias("top3"),
    )


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in [
        load_insert_if_absent,
        load_accounting,
        load_rejects,
        seed_status,
        sync_missing_status,
        taxonomy_upsert,
        taxonomy_json,
        late_method_column,
        orphan_status,
        cases_per_month,
        cases_per_register_month,
        subject_coverage,
        domain_totals,
        category_breakdown,
        pending_per_domain,
        method_audit,
        domain_share_by_entry_month,
        domain_share_by_register_month,
        domain_monthly_export,
        domain_monthly_export_text,
        progress_matrix,
        progress_summary,
        metrics_report,
        mark_blank,
        mark_no_keyword,
        keyword_misses,
        choice_criteria,
        closed_choice_criteria,
        build_prompts,
        engine_windows,
        classify_rules,
        classify_rules_with_keywords,
        rule_scores,
        pending_slice,
        normalise_generated_answers,
        normalise_choice_answers,
        apply_outcomes,
        classify_callable,
        classify_model,
        reset_month,
        reset_month_keep_method,
        purge_months_status,
        purge_months_cases,
        export_month,
        sample_strata,
        evaluate_rows,
        evaluate_sample,
        agreement_global,
        agreement_by_domain,
        agreement_by_category,
        confusion_matrix,
        confusion_wide,
        predicted_distribution,
        top_disagreements,
    ]
}
