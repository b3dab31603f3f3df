"""The classification cascade: blank, optional keyword filter, engine.

Text is looked at where it is stored. The cheap steps and the term rules turn each text into a few
flags in the scan's own stage, so joins with the status rows move keys and flags, never texts.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemill.fixed_values import METHOD_BLANK, METHOD_KEYWORDS, NOT_APPLICABLE
from casemill.functions.text import any_keyword, has_text, is_blank
from casemill.operators.engines import TermRules
from casemill.operators.status import rewrite
from casemill.operators.taxonomy import Domain, by_domain
from casemill.session import durable

# The answers of so many passes are stored as one table, so that the last plan stays small.
UNITED_PASSES = 20


def mark_blank(
    status: DataFrame, cases: DataFrame, domains: Sequence[str] | None = None
) -> DataFrame:
    """Pending rows of cases with a blank subject are done, without a category.

    All domains unless some are named.
    """
    blank = cases.filter(is_blank(F.col("subject"))).select("case_id", F.lit(True).alias("_hit"))
    hit = F.col("_hit")
    if domains is not None:
        hit = hit & F.col("domain").isin(list(domains))
    return _finish(status, status.join(blank, "case_id", "left"), hit, METHOD_BLANK)


def keyword_misses(cases: DataFrame, domains: Sequence[Domain]) -> DataFrame:
    """Per case with a subject, the domains none of whose keywords occur in it.

    A domain without keywords filters nothing and is never listed.
    """
    filtering = [d for d in domains if d.keywords]
    lowered = cases.filter(F.col("subject").isNotNull()).select(
        "case_id", F.lower("subject").alias("_text")
    )
    missed = F.array_compact(
        F.array(
            *[F.when(~any_keyword(F.col("_text"), d.keywords), F.lit(d.name)) for d in filtering]
        ).cast("array<string>")
    )
    return lowered.select("case_id", missed.alias("missed"))


def mark_no_keyword(
    status: DataFrame, cases: DataFrame, domains: Sequence[Domain]
) -> DataFrame:
    """Pending rows without any keyword of their domain are done, without a category.

    Rows without a subject stay as they are, and so do domains without keywords.
    """
    joined = status.join(keyword_misses(cases, domains), "case_id", "left")
    return _finish(status, joined, F.array_contains("missed", F.col("domain")), METHOD_KEYWORDS)


def _by_progress(status: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The finished rows, which no step changes, and the pending ones: only these are joined."""
    pending = F.col("processed").eqNullSafe(False)
    return status.filter(~pending), status.filter(pending)


def _finish(status: DataFrame, joined: DataFrame, condition: Column, method: str) -> DataFrame:
    hit = ~F.col("processed") & F.coalesce(condition, F.lit(False))
    return rewrite(
        joined,
        status,
        category=F.when(~hit, F.col("category")),
        processed=F.col("processed") | hit,
        method=F.when(hit, method).otherwise(F.col("method")),
    )


def pending_texts(status: DataFrame, cases: DataFrame) -> DataFrame:
    """F6 + J1: the texts that still wait for an answer, one row per case.

    ``domains`` lists who waits (at most one entry per configured domain). Blank texts and
    finished rows are filtered before the join.
    """
    waiting = (
        status.filter(~F.col("processed"))
        .groupBy("case_id")
        .agg(F.collect_set("domain").alias("domains"))
    )
    texts = cases.filter(has_text(F.col("subject"))).select("case_id", "subject")
    return texts.join(waiting, "case_id")


def pending_slice(texts: DataFrame, size: int) -> DataFrame:
    """O3: a bounded, repeatable slice of the waiting texts. The default is to take all."""
    return texts.orderBy("case_id").limit(size)


def apply_outcomes(status: DataFrame, answers: DataFrame, method: str) -> DataFrame:
    """Answered pending rows are done; ``NO_APLICA`` means no category.

    A NULL answer leaves its row pending. Keyed by case and domain, so repeating it is harmless.
    """
    given = answers.filter(F.col("answer").isNotNull()).select("case_id", "domain", "answer")
    joined = status.join(given, ["case_id", "domain"], "left")
    hit = ~F.col("processed") & F.col("answer").isNotNull()
    category = F.nullif(F.col("answer"), F.lit(NOT_APPLICABLE))
    return rewrite(
        joined,
        status,
        category=F.when(hit, category).otherwise(F.col("category")),
        processed=F.col("processed") | hit,
        method=F.when(hit, method).otherwise(F.col("method")),
    )


def _rule_outcomes(
    cases: DataFrame, domains: Sequence[Domain], rules: TermRules, keyword_filter: bool
) -> tuple[DataFrame, dict[str, Column]]:
    """The whole cascade as columns of one projection of ``cases``; an outcome per domain."""
    prepared = cases.select(
        "case_id",
        is_blank(F.col("subject")).alias("_blank"),
        F.lower("subject").alias("_text"),
    )
    scored, names = rules.with_scores(prepared, "_text", domains)
    outcomes = {}
    for d in domains:
        method = F.when(F.col("_blank"), METHOD_BLANK)
        if keyword_filter and d.keywords:
            method = method.when(~any_keyword(F.col("_text"), d.keywords), METHOD_KEYWORDS)
        answer = rules.answer(d, names[d.name])
        outcomes[d.name] = F.struct(
            F.lit(d.name).alias("domain"),
            method.otherwise(rules.method).alias("method"),
            F.nullif(answer, F.lit(NOT_APPLICABLE)).alias("answer"),
        )
    return scored, outcomes


def _category(outcome: str, method: str) -> Column:
    """Only a row that reached the engine has a category."""
    return F.when(F.col(f"{outcome}.method") == method, F.col(f"{outcome}.answer"))


def classify_new(
    cases: DataFrame,
    domains: Sequence[Domain],
    rules: TermRules,
    keyword_filter: bool = False,
) -> DataFrame:
    """S7 + C1 + C2 + C6 + C9 for newly loaded cases: one scan, no join, no shuffle.

    Equals seeding the cases and then running the steps one by one.
    """
    scored, outcomes = _rule_outcomes(cases, domains, rules, keyword_filter)
    rows = scored.select("case_id", F.explode(F.array(*outcomes.values())).alias("o"))
    return rows.select(
        "o.domain",
        "case_id",
        _category("o", rules.method).alias("category"),
        F.lit(True).alias("processed"),
        "o.method",
    )


def classify_pending(
    status: DataFrame,
    cases: DataFrame,
    domains: Sequence[Domain],
    rules: TermRules,
    keyword_filter: bool = False,
) -> DataFrame:
    """C1 + C2 + C6 + C9 + C11 by term rules over existing status rows, all domains at once.

    Each text is judged for all domains in the scan stage; only the verdicts are joined.
    Finished rows and rows without a case stay as they are.
    """
    finished, pending = _by_progress(status)
    scored, outcomes = _rule_outcomes(cases, domains, rules, keyword_filter)
    verdicts = scored.select(
        "case_id", *[o.dropFields("domain").alias(f"_o{i}") for i, o in enumerate(outcomes.values())]
    )
    picked = by_domain(F.col("domain"), {n: F.col(f"_o{i}") for i, n in enumerate(outcomes)})
    # Rows shrink so much in a shuffle that a merging of small partitions would fill one task.
    n = int(status.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = pending.repartition(n, "case_id").join(verdicts, "case_id", "left")
    rows = rows.withColumn("_o", picked)
    hit = F.col("_o").isNotNull()
    judged = rewrite(
        rows,
        status,
        category=F.when(hit, _category("_o", rules.method)).otherwise(F.col("category")),
        processed=hit,
        method=F.when(hit, F.col("_o.method")).otherwise(F.col("method")),
    )
    return finished.unionByName(judged)


def classify_in_passes(
    status: DataFrame,
    cases: DataFrame,
    domains: Sequence[Domain],
    engine,
    max_passes: int | None = None,
    keyword_filter: bool = False,
    materialise: Callable[[DataFrame], DataFrame] = durable,
) -> DataFrame:
    """C1, C2, then engine passes over what is still pending (C10, C11); the given domains only.

    The waiting texts are joined and stored once. The answers of a pass are computed once into
    durable storage, because an external engine may answer differently when asked again; its
    failed rows are what the next pass asks. A domain leaves the loop when a pass answers nothing
    for it or leaves nothing pending; ``max_passes`` stops earlier if the caller wants that. All
    answers are applied to the status rows by one join at the end.
    """
    names = [d.name for d in domains]
    finished, pending = _by_progress(status)
    prepared = mark_blank(pending, cases, names)
    if keyword_filter:
        prepared = mark_no_keyword(prepared, cases, domains)
    chosen = prepared.filter(F.col("domain").isin(names))
    waiting = materialise(pending_texts(chosen, cases))
    given: list[DataFrame] = []
    todo = waiting
    passes = 0
    while max_passes is None or passes < max_passes:
        scored = engine.score(todo, domains).select("case_id", "domain", "answer")
        answers = materialise(engine.normalise(scored, domains))
        given.append(answers.filter(F.col("answer").isNotNull()))
        passes += 1
        if len(given) == UNITED_PASSES:
            given = [materialise(reduce(DataFrame.unionByName, given))]
        progress = answers.groupBy("domain").agg(
            F.count("answer").alias("answered"),
            F.count_if(F.col("answer").isNull()).alias("failed"),
        )
        active = [r.domain for r in progress.collect() if r.answered and r.failed]
        if not active:
            break
        failed = (
            answers.filter(F.col("answer").isNull() & F.col("domain").isin(active))
            .groupBy("case_id")
            .agg(F.collect_set("domain").alias("domains"))
        )
        todo = waiting.drop("domains").join(failed, "case_id")
    if given:
        prepared = apply_outcomes(prepared, reduce(DataFrame.unionByName, given), engine.method)
    return finished.unionByName(prepared)
