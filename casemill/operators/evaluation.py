"""Agreement of a second engine with stored labels (C13, A12..A16, O4, X12, X13)."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from casemill.fixed_values import ERROR_LABEL, NOT_APPLICABLE
from casemill.functions.numbers import percent
from casemill.operators.taxonomy import Domain

# Fixed value: how many disagreements the published report shows.
SHOWN_DISAGREEMENTS = 8

# Column of the wide confusion table for predictions that are none of the labels.
OTHER_LABEL = "OTHER"


def evaluate(
    sample: DataFrame, domains: Sequence[Domain], engine, with_text: bool = False
) -> DataFrame:
    """Predict every sampled row and compare with its stored label, exactly.

    ``sample`` has ``case_id, domain, original_category, original_method, subject``. The engine's
    raw answer is the prediction. A failure predicts ``ERROR…`` with confidence 0: a miss.
    ``with_text`` carries the text through to the result, as the published rows do.
    """
    text = [F.col("subject").alias("text")] if with_text else []
    texts = sample.select(
        "case_id",
        "subject",
        F.array("domain").alias("domains"),
        "original_category",
        "original_method",
        *text,
    )
    keep = texts.columns[3:]
    scored = engine.score(texts, domains, keep)
    failed = F.col("error").isNotNull()
    predicted = F.when(failed, F.concat(F.lit(f"{ERROR_LABEL}: "), F.col("error"))).otherwise(
        F.coalesce("answer", F.lit(ERROR_LABEL))
    )
    wrong = failed | F.col("answer").isNull()
    return scored.select(
        "case_id",
        "domain",
        "original_category",
        "original_method",
        *([F.col("text").alias("subject")] if with_text else []),
        predicted.alias("predicted"),
        F.coalesce(predicted == F.col("original_category"), F.lit(False)).alias("match"),
        _or_zero("confidence", wrong),
        _or_zero("margin", wrong),
        "latency_s",
        F.coalesce("probabilities", F.create_map().cast("map<string,double>")).alias(
            "probabilities"
        ),
    )


def _or_zero(name: str, wrong: Column) -> Column:
    return F.when(wrong, 0.0).otherwise(F.coalesce(name, F.lit(0.0))).alias(name)


def result_rows(evaluated: DataFrame) -> DataFrame:
    """The evaluation as published, every number rounded to four decimals."""
    return evaluated.withColumns(
        {
            "confidence": F.round("confidence", 4),
            "margin": F.round("margin", 4),
            "latency_s": F.round("latency_s", 4),
            "probabilities": F.transform_values("probabilities", lambda _, p: F.round(p, 4)),
        }
    )


def _agreement() -> list[Column]:
    return [F.count("*").alias("total"), F.count_if("match").alias("matches")]


def _agreement_pct() -> Column:
    return F.round(percent(F.col("matches"), F.col("total")), 2)


def agreement_global(evaluated: DataFrame) -> DataFrame:
    """The mean is over the published (rounded) confidences."""
    counts = evaluated.agg(
        *_agreement(),
        F.round(F.coalesce(F.avg(F.round("confidence", 4)), F.lit(0.0)), 4).alias(
            "mean_confidence"
        ),
    )
    return counts.select("total", "matches", _agreement_pct().alias("agreement_pct"),
                         "mean_confidence")


def agreement_by_domain(evaluated: DataFrame) -> DataFrame:
    """A13. ``mean_latency_ms`` is NULL for engines that score inside the JVM."""
    return (
        evaluated.groupBy("domain")
        .agg(
            *_agreement(),
            F.round(F.avg("latency_s") * 1000, 2).alias("mean_latency_ms"),
            F.round(F.avg("confidence"), 4).alias("mean_confidence"),
        )
        .withColumn("agreement_pct", _agreement_pct())
        .orderBy("domain")
    )


def agreement_by_category(evaluated: DataFrame) -> DataFrame:
    """A14."""
    return (
        evaluated.groupBy("domain", "original_category")
        .agg(*_agreement())
        .withColumn("agreement_pct", _agreement_pct())
        .orderBy("domain", "original_category")
    )


def confusion_matrix(evaluated: DataFrame) -> DataFrame:
    """Rows (domain, original, predicted, total)."""
    return (
        evaluated.groupBy("domain", "original_category", "predicted")
        .agg(F.count("*").alias("total"))
        .orderBy("domain", "original_category", F.col("total").desc(), "predicted")
    )


def _without_error_text(predicted: Column) -> Column:
    """Error texts are free; in the wide and nested forms they share one label."""
    return F.when(predicted.startswith(ERROR_LABEL), ERROR_LABEL).otherwise(predicted)


def confusion_wide(evaluated: DataFrame, domain: str, labels: Sequence[str]) -> DataFrame:
    """A15 as a cross table of one domain; ``labels`` are the prediction columns.

    ``NO_APLICA``, all errors together and any other prediction have columns of their own, so the
    columns of a row add up to ``total``, the count of the category report (A14).
    """
    columns = list(dict.fromkeys([*labels, NOT_APPLICABLE, ERROR_LABEL]))
    predicted = _without_error_text(F.col("predicted"))
    shown = F.when(predicted.isin(columns), predicted).otherwise(OTHER_LABEL)
    return (
        evaluated.filter(F.col("domain") == domain)
        .groupBy("original_category")
        .agg(
            *[F.count_if(shown == c).alias(c) for c in [*columns, OTHER_LABEL]],
            F.count("*").alias("total"),
        )
        .orderBy("original_category")
    )


def predicted_distribution(evaluated: DataFrame) -> DataFrame:
    """A15 in its nested form: per (domain, original) a map prediction -> count.

    The map holds at most the domain's categories, ``NO_APLICA`` and one error entry.
    """
    counts = evaluated.groupBy(
        "domain", "original_category", _without_error_text(F.col("predicted")).alias("predicted")
    ).agg(F.count("*").alias("n"))
    return counts.groupBy("domain", "original_category").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("predicted", "n")))).alias(
            "predicted"
        )
    )


@dataclass(frozen=True)
class EvaluationRun:
    """What a run evaluated and how long it took until its results were written."""

    total: int
    matches: int
    failures: int
    wall_seconds: float

    @property
    def rows_per_second(self) -> float:
        return round(self.total / self.wall_seconds, 2) if self.wall_seconds else 0.0


def write_results(rows: DataFrame, path: str) -> EvaluationRun:
    """Write result rows as JSON lines; the counts are taken on the way, so the engine runs once."""
    watch = Observation()
    watched = rows.observe(
        watch,
        F.count(F.lit(1)).alias("total"),
        F.count_if("match").alias("matches"),
        F.count_if(F.col("predicted").startswith(ERROR_LABEL)).alias("failures"),
    )
    started = time.monotonic()
    watched.write.mode("error").json(path, ignoreNullFields=False)
    seconds = time.monotonic() - started
    counts = watch.get
    return EvaluationRun(counts["total"], counts["matches"], counts["failures"], seconds)


def throughput(evaluated: DataFrame, wall_seconds: float) -> DataFrame:
    """Rows per second and mean milliseconds of a run that took ``wall_seconds``."""
    seconds = F.lit(float(wall_seconds))
    return evaluated.agg(F.count("*").alias("total")).select(
        "total",
        F.round(seconds, 2).alias("wall_seconds"),
        F.round(F.coalesce(F.try_divide(F.col("total"), seconds), F.lit(0.0)), 2).alias(
            "rows_per_second"
        ),
        F.round(
            F.coalesce(F.try_divide(seconds, F.col("total")) * 1000, F.lit(0.0)), 2
        ).alias("mean_latency_ms"),
    )


def top_disagreements(evaluated: DataFrame, k: int = SHOWN_DISAGREEMENTS) -> DataFrame:
    """O4 + X13: the first ``k`` misses by case, with their three likeliest categories."""
    by_chance = F.array_sort(
        F.map_entries("probabilities"),
        lambda a, b: F.when(a["value"] > b["value"], -1)
        .when(a["value"] < b["value"], 1)
        .when(a["key"] < b["key"], -1)
        .when(a["key"] > b["key"], 1)
        .otherwise(0),
    )
    return (
        result_rows(evaluated.filter(~F.col("match")))
        .orderBy("case_id", "domain")
        .limit(k)
        .withColumn("top3", F.slice(by_chance, 1, 3))
    )
