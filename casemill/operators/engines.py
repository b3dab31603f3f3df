"""Scoring engines (C6): term rules, a naive Bayes text model, and any user callable.

Every engine offers ``score(texts, domains, keep=())``. ``texts`` has one row per case,
``(case_id, subject, domains array<string>)``, so a text is shuffled and prepared once however
many domains ask about it. The result has one row per case and asked domain:
``case_id, domain, *keep, answer, confidence, margin, probabilities, latency_s, error``.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casemill.fixed_values import METHOD_MODEL, NOT_APPLICABLE
from casemill.operators.answers import normalise_choice
from casemill.operators.taxonomy import Domain, by_domain
from casemill.schema import SCORE_FIELDS
from casemill.session import staged

Terms = dict[str, dict[str, Sequence[str]]]


def _explode_asked(scored: DataFrame, keep: Sequence[str], verdicts: list[Column]) -> DataFrame:
    """One row per verdict whose domain the row asks about."""
    return (
        scored.select("case_id", *keep, "domains", F.explode(F.array(*verdicts)).alias("v"))
        .filter(F.array_contains("domains", F.col("v.domain")))
        .select("case_id", "v.domain", *keep, *[f"v.{f.name}" for f in SCORE_FIELDS])
    )


def _verdict(
    domain: str, answer: Column, confidence: Column, margin: Column, probabilities: Column
) -> Column:
    return F.struct(
        F.lit(domain).alias("domain"),
        answer.alias("answer"),
        confidence.alias("confidence"),
        margin.alias("margin"),
        probabilities.alias("probabilities"),
        F.lit(None).cast("double").alias("latency_s"),
        F.lit(None).cast("string").alias("error"),
    )


@dataclass(frozen=True)
class TermRules:
    """Scores a category by how many of its terms occur in the text (case-insensitive).

    A category without listed terms is looked for by its own name. The best score wins, the
    earlier category on a tie; without any hit the answer is ``NO_APLICA``, or in a closed world
    the first category at equal probabilities. Everything is a native column expression.
    """

    terms: Terms
    closed: bool = False
    method: str = METHOD_MODEL

    normalise = staticmethod(normalise_choice)

    def with_scores(
        self,
        df: DataFrame,
        lowered: str,
        domains: Sequence[Domain],
        asked: Callable[[Domain], Column] | None = None,
    ) -> tuple[DataFrame, dict[str, list[str]]]:
        """Add one integer column per category, named per domain in category order.

        The lower-cased text must be a column of its own: each score reads it, and Catalyst keeps
        a projection apart that is read more than once, so the text is lower-cased once.
        ``asked`` tells whether a row asks about a domain; if not, its text is not searched.
        """
        columns: dict[str, Column] = {}
        names: dict[str, list[str]] = {}
        for i, d in enumerate(domains):
            names[d.name] = []
            for j, category in enumerate(d.categories):
                terms = self.terms.get(d.name, {}).get(category, [category])
                hits = [
                    F.coalesce(F.col(lowered).contains(t.lower()), F.lit(False)).cast("int")
                    for t in terms
                ]
                found = reduce(add, hits)
                columns[f"_score_{i}_{j}"] = F.when(asked(d), found) if asked else found
                names[d.name].append(f"_score_{i}_{j}")
        return df.withColumns(columns), names

    def answer(self, domain: Domain, names: Sequence[str]) -> Column:
        best = _greatest(names)
        picked = F.lit(domain.categories[-1])
        for category, name in reversed(list(zip(domain.categories, names, strict=True))):
            picked = F.when(F.col(name) == best, category).otherwise(picked)
        if self.closed:
            return picked
        return F.when(best == 0, NOT_APPLICABLE).otherwise(picked)

    def score(
        self, texts: DataFrame, domains: Sequence[Domain], keep: Sequence[str] = ()
    ) -> DataFrame:
        prepared = texts.select("case_id", *keep, "domains", F.lower("subject").alias("_text"))
        scored, names = self.with_scores(
            prepared, "_text", domains, lambda d: F.array_contains("domains", d.name)
        )
        verdicts = [self._scored_verdict(d, names[d.name]) for d in domains]
        return _explode_asked(scored, keep, verdicts)

    def _scored_verdict(self, d: Domain, names: Sequence[str]) -> Column:
        total = reduce(add, [F.col(n) for n in names])
        ranked = F.sort_array(F.array(*[F.col(n) for n in names]), asc=False)
        second = ranked[1] if len(names) > 1 else F.lit(0)
        none = F.lit(1.0 / len(names)) if self.closed else F.lit(0.0)

        def share(n: Column) -> Column:
            return F.coalesce(F.try_divide(n.cast("double"), total.cast("double")), none)

        pairs = [part for c, n in zip(d.categories, names, strict=True)
                 for part in (F.lit(c), share(F.col(n)))]
        if self.closed:
            confidence, margin = share(ranked[0]), share(ranked[0]) - (
                share(second) if len(names) > 1 else F.lit(0.0)
            )
        else:
            refused = F.when(total == 0, 1.0).otherwise(0.0)
            pairs += [F.lit(NOT_APPLICABLE), refused]
            confidence = F.when(total == 0, 1.0).otherwise(share(ranked[0]))
            margin = F.when(total == 0, 1.0).otherwise(share(ranked[0]) - share(second))
        return _verdict(d.name, self.answer(d, names), confidence, margin, F.create_map(*pairs))


def _greatest(names: Sequence[str]) -> Column:
    return F.greatest(*names) if len(names) > 1 else F.col(names[0])


#: Decimals of a joint score: the order in which its terms were added can't decide an answer.
SCORE_DECIMALS = 6


def _words(text: Column) -> Column:
    """The lower-cased runs of letters and digits of a text."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


@dataclass(frozen=True)
class TextModel:
    """A multinomial naive Bayes text model over the joint label (domain, category).

    The vocabulary is exact: one row a word with its count under every joint label, made by one
    aggregation over the words of all labelled texts, and kept as a table. Priors and the labels'
    totals are two numbers a label. With add-one smoothing the score of label i is
    ``prior_i + sum over known words of ln(count_i + 1) - n_known * ln(total_i + n_words)``;
    words that no labelled text has are left out. Within a domain the joint scores are
    renormalised, which gives that domain's own model. All of it runs in the JVM.
    """

    vocabulary: DataFrame
    labels: tuple[tuple[str, str], ...]
    priors: tuple[float, ...]
    totals: tuple[int, ...]
    n_words: int
    method: str = METHOD_MODEL

    normalise = staticmethod(normalise_choice)

    @classmethod
    def fit(
        cls, labelled: DataFrame, cases: DataFrame, method: str = METHOD_MODEL
    ) -> TextModel:
        """Train on processed status rows: a NULL category counts as ``NO_APLICA``.

        A few numbers per label reach the driver; the vocabulary stays a table.
        """
        label = F.coalesce("category", F.lit(NOT_APPLICABLE))
        rows = labelled.select("case_id", "domain", label.alias("label"))
        found = rows.groupBy("domain", "label").count().orderBy("domain", "label").collect()
        labels = tuple((r.domain, r.label) for r in found)
        asked = {d: sum(r["count"] for r in found if r.domain == d) for d, _ in labels}
        priors = tuple(math.log(r["count"] / asked[r.domain]) for r in found)
        index: dict[str, Column] = {}
        for d in asked:
            index[d] = by_domain(
                F.col("label"),
                {c: F.lit(i) for i, (owner, c) in enumerate(labels) if owner == d},
            )
        joint = by_domain(F.col("domain"), index) if labels else F.lit(0)
        own = rows.groupBy("case_id").agg(F.collect_list(joint).alias("own"))
        words = (
            cases.filter(F.col("subject").isNotNull())
            .select("case_id", "subject")
            .join(own, "case_id")
            .select("own", F.explode(_words(F.col("subject"))).alias("word"))
        )
        counts = [
            F.count_if(F.array_contains("own", i)).alias(f"n_{i}") for i in range(len(labels))
        ]
        vocabulary = staged(
            words.groupBy("word").agg(*counts) if counts
            else cases.sparkSession.createDataFrame([], "word string"),
            "vocabulary",
        )
        sums = vocabulary.agg(
            F.count("*").alias("n_words"),
            *[F.coalesce(F.sum(f"n_{i}"), F.lit(0)).alias(f"n_{i}") for i in range(len(labels))],
        ).head()
        totals = tuple(int(sums[f"n_{i}"]) for i in range(len(labels)))
        return cls(vocabulary, labels, priors, totals, int(sums.n_words), method)

    def _joint_scores(self, texts: DataFrame) -> DataFrame:
        """case_id and the joint score of every label, as an array."""
        n = range(len(self.labels))
        logs = [F.sum(F.log1p(f"n_{i}")).alias(f"s_{i}") for i in n]
        words = texts.select(
            "case_id", F.explode(_words(F.coalesce("subject", F.lit("")))).alias("word")
        )
        known = (
            words.join(self.vocabulary, "word")
            .groupBy("case_id")
            .agg(F.count("*").alias("n_known"), *logs)
        )
        scores = [
            F.round(
                F.lit(self.priors[i])
                + F.coalesce(f"s_{i}", F.lit(0.0))
                - F.coalesce("n_known", F.lit(0))
                * F.lit(math.log(self.totals[i] + self.n_words) if self.n_words else 0.0),
                SCORE_DECIMALS,
            )
            for i in n
        ]
        joint = F.array(*scores) if scores else F.array().cast("array<double>")
        return texts.select("case_id").join(known, "case_id", "left").select(
            "case_id", joint.alias("_joint")
        )

    def score(
        self, texts: DataFrame, domains: Sequence[Domain], keep: Sequence[str] = ()
    ) -> DataFrame:
        joint = texts.select("case_id", *keep, "domains").join(
            self._joint_scores(texts), "case_id"
        )
        known = {d.name: self._own(d) for d in domains}
        own_scores = {
            f"_own_{i}": F.array(*[F.col("_joint")[at] for _, at in own])
            for i, own in enumerate(known.values())
            if own
        }
        joint = joint.withColumns(own_scores)
        joint = joint.withColumns(
            {f"{name}_best": F.array_max(F.col(name)) for name in own_scores}
        )
        weights = {
            name.replace("_own_", "_weights_"): _softmax(F.col(name), F.col(f"{name}_best"))
            for name in own_scores
        }
        verdicts = []
        for i, (name, own) in enumerate(known.items()):
            labels = [label for label, _ in own]
            verdicts.append(_ranked_verdict(name, labels, F.col(f"_weights_{i}")) if own
                            else _no_verdict(name))
        return _explode_asked(joint.withColumns(weights), keep, verdicts)

    def _own(self, d: Domain) -> list[tuple[str, int]]:
        """The domain's labels and where they stand in the joint prediction."""
        return [(c, i) for i, (owner, c) in enumerate(self.labels) if owner == d.name]


def _softmax(logits: Column, best: Column) -> Column:
    return F.transform(logits, lambda x: F.exp(x - best))


def _ranked_verdict(domain: str, labels: Sequence[str], weights: Column) -> Column:
    """The likeliest label of unnormalised weights; the earlier label on a tie."""
    total = F.aggregate(weights, F.lit(0.0), lambda a, w: a + w)
    shares = F.transform(weights, lambda w: w / total)
    ranked = F.sort_array(shares, asc=False)
    names = F.array(*map(F.lit, labels))
    answer = F.element_at(names, F.array_position(weights, F.array_max(weights)).cast("int"))
    second = F.coalesce(F.get(ranked, F.lit(1)), F.lit(0.0))
    return _verdict(
        domain, answer, ranked[0], ranked[0] - second, F.map_from_arrays(names, shares)
    )


def _no_verdict(domain: str) -> Column:
    """Nothing is known about the domain: a failed answer."""
    number = F.lit(None).cast("double")
    chances = F.lit(None).cast("map<string,double>")
    return _verdict(domain, F.lit(None).cast("string"), number, number, chances)


Predict = Callable[[pd.DataFrame], Sequence[Any]]


@dataclass(frozen=True)
class CallableEngine:
    """Any Python scorer, run over Arrow batches of the pending rows.

    ``factory()`` is called once per task and returns ``predict(batch)``: it gets a pandas frame
    with the ``request`` columns and returns one item per row, either an answer text, None for a
    failure, or a dict with any of ``answer, confidence, margin, probabilities``.

    A raised error is retried (an exception's ``retry_after`` attribute sets the wait), then the
    batch is halved until the bad rows are alone; what still fails becomes a NULL answer with its
    error text, never a failed job. ``concurrency`` bounds the tasks that call the scorer.
    """

    factory: Callable[[], Predict]
    method: str = METHOD_MODEL
    normalise: Callable[[DataFrame, Sequence[Domain]], DataFrame] = normalise_choice
    prepare: Callable[[DataFrame, Sequence[Domain]], DataFrame] | None = None
    batch_rows: int = 200
    retries: int = 1
    wait_s: float = 0.5
    concurrency: int | None = None

    def score(
        self, texts: DataFrame, domains: Sequence[Domain], keep: Sequence[str] = ()
    ) -> DataFrame:
        if self.concurrency:
            texts = texts.repartition(self.concurrency, "case_id")
        rows = texts.select("case_id", F.explode("domains").alias("domain"), *keep, "subject")
        if self.prepare is not None:
            rows = self.prepare(rows, domains)
        kept = ["case_id", "domain", *keep]
        schema = T.StructType([*[rows.schema[c] for c in kept], *SCORE_FIELDS])
        score_batch = _batch_scorer(self.batch_rows, self.retries, self.wait_s, kept)
        factory = self.factory

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            predict = factory()
            for batch in batches:
                yield from score_batch(predict, batch)

        return rows.mapInPandas(run, schema)


def _batch_scorer(batch_rows: int, row_retries: int, wait_s: float, kept: Sequence[str]):
    """A function that applies a scorer to one Arrow batch with bounded retries.

    It is made of nested functions only, so it travels to the executors by value.
    """

    def attempt(predict, part, retries):
        started = time.perf_counter()
        error = None
        for trial in range(retries + 1):
            try:
                results = list(predict(part))
                if len(results) != len(part):
                    raise ValueError(f"{len(results)} answers for {len(part)} rows")
                return results, None, time.perf_counter() - started
            except Exception as problem:  # noqa: BLE001 - a failing scorer must not fail the job
                error = str(problem) or type(problem).__name__
                if trial < retries:
                    time.sleep(getattr(problem, "retry_after", wait_s * (trial + 1)))
        return None, error, time.perf_counter() - started

    def score_part(predict, part, retries):
        """One (item, error, seconds) per row. A failing part is halved until the bad rows are
        alone, so a few of them cost few extra calls; a row alone gets the full retries."""
        results, error, elapsed = attempt(predict, part, retries)
        if error is None:
            return [(item, None, elapsed / len(part)) for item in results]
        if len(part) == 1:
            return [(None, error, elapsed)]
        outcomes = []
        middle = len(part) // 2
        for half in (part.iloc[:middle], part.iloc[middle:]):
            outcomes += score_part(predict, half, row_retries if len(half) == 1 else 0)
        return outcomes

    def frame(part, outcomes):
        items = [r if isinstance(r, dict) else {"answer": r} for r, _, _ in outcomes]
        out = part[list(kept)].reset_index(drop=True)
        for name in ("answer", "confidence", "margin", "probabilities"):
            out[name] = pd.Series([item.get(name) for item in items], dtype=object)
        for name in ("confidence", "margin"):
            out[name] = out[name].astype("Float64")
        out["latency_s"] = [seconds for _, _, seconds in outcomes]
        out["error"] = pd.Series([e for _, e, _ in outcomes], dtype=object)
        return out

    def score_batch(predict, batch):
        for start in range(0, len(batch), batch_rows):
            part = batch.iloc[start : start + batch_rows]
            yield frame(part, score_part(predict, part, row_retries))

    return score_batch
