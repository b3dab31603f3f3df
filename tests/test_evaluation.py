import json

import pytest
from conftest import as_set, plan_of
from pyspark.sql import functions as F

from casemill import fixed_values as fixed
from casemill.operators import evaluation as ev
from casemill.operators.engines import CallableEngine, TermRules
from casemill.operators.sampling import stratified_sample
from casemill.operators.taxonomy import Domain
from casemill.plans import queries
from casemill.sources.delimited import write_rows

PETS = Domain("pets", ("Dog", "Cat", "Bird", "Fish", "Mouse"))


def strata(spark, sizes):
    """A status table with the given rows per (domain, category), and its cases."""
    rows = [(d, f"{d}{c}{i}", c) for (d, c), n in sizes.items() for i in range(n)]
    status = spark.createDataFrame(rows, "domain string, case_id string, category string")
    status = status.selectExpr("domain", "case_id", "category", "true AS processed", "'IA' AS method")
    return status, status.select("case_id", F.concat(F.lit("text "), "case_id").alias("subject"))


def test_sample_keeps_quotas_and_repeats(spark):
    status, cases = strata(spark, {("a", "X"): 500, ("a", "Y"): 23, ("b", "X"): 80, ("b", "Q"): 9})
    quotas = {("a", "X"): 35, ("a", "Y"): 35, ("b", "X"): 70, ("c", "Z"): 5}
    drawn = stratified_sample(status, cases, quotas, seed=3)
    counts = drawn.groupBy("domain", "original_category").count()
    assert as_set(counts) == {("a", "X", 35), ("a", "Y", 23), ("b", "X", 70)}
    again = stratified_sample(status.repartition(5), cases.repartition(3), quotas, seed=3)
    assert as_set(again) == as_set(drawn)
    other = stratified_sample(status, cases, quotas, seed=4)
    assert as_set(other) != as_set(drawn)


def test_sample_equals_a_plain_ranking(spark):
    """The two cuts give what one global ranking per stratum gives."""
    import hashlib

    status, cases = strata(spark, {("a", "X"): 3000, ("b", "Y"): 40})
    drawn = as_set(stratified_sample(status, cases, {("a", "X"): 50, ("b", "Y"): 7}, 1), "case_id")

    def first(domain, category, n, quota):
        ids = [f"{domain}{category}{i}" for i in range(n)]
        return sorted(ids, key=lambda k: (hashlib.md5(f"1#{k}".encode()).hexdigest(), k))[:quota]

    assert drawn == {(k,) for k in [*first("a", "X", 3000, 50), *first("b", "Y", 40, 7)]}


def test_sample_skips_blank_texts(spark):
    status, _ = strata(spark, {("a", "X"): 3})
    cases = status.select("case_id", F.when(F.col("case_id") == "aX1", "t").otherwise(" ").alias("subject"))
    assert as_set(stratified_sample(status, cases, {("a", "X"): 5}), "case_id") == {("aX1",)}


def test_hot_stratum_is_cut_before_the_shuffle(spark):
    status, cases = strata(spark, {("a", "X"): 100})
    plan = plan_of(stratified_sample(status, cases, {("a", "X"): 10}))
    assert plan.count("WindowGroupLimit") >= 3 and "_slice" in plan


def test_shipped_quotas():
    assert sum(fixed.SAMPLE_QUOTAS.values()) == 1000
    for domain, categories in fixed.CATEGORIES.items():
        assert {c for d, c in fixed.SAMPLE_QUOTAS if d == domain} == set(categories)


def test_sample_query_draws_its_whole_language_strata(spark):
    drawn = queries.sample_strata(spark, "/root/testdata/sf0.01").filter("domain = 'language'")
    assert as_set(drawn.groupBy("original_category").count()) == {
        ("English", 35), ("German", 35), ("Spanish", 23), ("French", 47),
    }


def test_evaluation_of_the_sample_covers_its_whole_language_strata(spark):
    agreement = queries.evaluate_sample(spark, "/root/testdata/sf0.01")
    assert as_set(agreement.filter("domain = 'language'"), "original_category", "total") == {
        ("English", 35), ("German", 35), ("Spanish", 23), ("French", 47),
    }


def sample_of(spark, *rows):
    return spark.createDataFrame(
        [(*r[:3], "IA", r[3]) for r in rows],
        "case_id string, domain string, original_category string, original_method string, subject string",
    )


@pytest.fixture
def evaluated(spark):
    def factory():
        def predict(batch):
            out = []
            for text in batch["subject"]:
                if text == "boom":
                    raise RuntimeError("no model")
                chances = {"Dog": 0.5, "Cat": 0.123456, "Bird": 0.2, "Fish": 0.1, "Mouse": 0.05}
                out.append({"answer": text, "confidence": 0.55555, "margin": 0.3, "probabilities": chances})
            return out

        return predict

    rows = [("1", "pets", "Dog", "Dog"), ("2", "pets", "Dog", "Cat"), ("3", "pets", "Cat", "boom"),
            ("4", "pets", "Cat", "Cat"), ("5", "pets", "Bird", "Dog")]
    engine = CallableEngine(factory, retries=0)
    return ev.evaluate(sample_of(spark, *rows), [PETS], engine, with_text=True).cache()


def test_errors_count_as_misses(evaluated):
    row = evaluated.filter("case_id = '3'").head()
    assert row.predicted == "ERROR: no model" and row.confidence == 0.0 and not row.match
    assert row.probabilities == {}
    total = ev.agreement_global(evaluated).head()
    assert (total.total, total.matches, total.agreement_pct) == (5, 2, 40.0)
    assert total.mean_confidence == pytest.approx(0.4445, abs=1e-4)


def test_agreement_grains(evaluated):
    by_domain = ev.agreement_by_domain(evaluated).head()
    assert (by_domain.total, by_domain.matches) == (5, 2) and by_domain.mean_latency_ms >= 0
    by_category = as_set(ev.agreement_by_category(evaluated))
    assert by_category == {
        ("pets", "Dog", 2, 1, 50.0), ("pets", "Cat", 2, 1, 50.0), ("pets", "Bird", 1, 0, 0.0),
    }
    matrix = ev.confusion_matrix(evaluated)
    sums = matrix.groupBy("domain", "original_category").agg(F.sum("total").alias("n"))
    assert as_set(sums) == {r[:3] for r in by_category}


def test_confusion_forms(evaluated):
    wide = {r.original_category: r for r in ev.confusion_wide(evaluated, "pets", ["Dog", "Cat"]).collect()}
    assert (wide["Dog"].Dog, wide["Dog"].Cat, wide["Bird"].Cat) == (1, 1, 0)
    errors = {r.original_category: (r.ERROR, r.NO_APLICA, r.OTHER) for r in wide.values()}
    assert errors["Cat"] == (1, 0, 0)
    totals = {r.original_category: r.total for r in ev.agreement_by_category(evaluated).collect()}
    for category, r in wide.items():
        assert r.Dog + r.Cat + r.NO_APLICA + r.ERROR + r.OTHER == r.total == totals[category]
    nested = {r.original_category: r.predicted for r in ev.predicted_distribution(evaluated).collect()}
    assert nested == {"Dog": {"Dog": 1, "Cat": 1}, "Cat": {"Cat": 1, "ERROR": 1}, "Bird": {"Dog": 1}}


def test_top_disagreements(evaluated):
    shown = ev.top_disagreements(evaluated, 2).collect()
    assert [r.case_id for r in shown] == ["2", "3"]
    assert [(e.key, e.value) for e in shown[0].top3] == [("Dog", 0.5), ("Bird", 0.2), ("Cat", 0.1235)]
    assert ev.top_disagreements(evaluated).count() == 3


def test_throughput(spark, evaluated):
    assert tuple(ev.throughput(evaluated, 0.25).head()) == (5, 0.25, 20.0, 50.0)
    assert tuple(ev.throughput(evaluated.filter("false"), 0.0).head()) == (0, 0.0, 0.0, 0.0)


def test_empty_evaluation(spark, evaluated):
    assert tuple(ev.agreement_global(evaluated.filter("false")).head()) == (0, 0, 0.0, 0.0)


def test_results_as_json_and_csv(evaluated, tmp_path, spark):
    out = str(tmp_path / "results")
    columns = ["case_id", "domain", "original_category", "predicted", "match", "confidence", "subject"]
    write_rows(ev.result_rows(evaluated).coalesce(1), out, columns)
    lines = [json.loads(x) for f in (tmp_path / "results/json").glob("*.json") for x in f.open()]
    first = next(x for x in lines if x["case_id"] == "2")
    assert first["probabilities"]["Cat"] == 0.1235 and first["subject"] == "Cat"
    csv = spark.read.option("header", True).csv(f"{out}/csv")
    assert csv.columns == columns and csv.count() == 5


def test_rules_need_no_python(spark):
    sample = sample_of(spark, ("1", "pets", "Dog", "a dog"), ("2", "pets", "Cat", "a bird"))
    result = ev.evaluate(sample, [PETS], TermRules({}, closed=True))
    assert as_set(result, "case_id", "predicted", "match") == {("1", "Dog", True), ("2", "Bird", False)}
    assert "Python" not in plan_of(result) and "MapInPandas" not in plan_of(result)


def test_results_are_counted_while_written(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()

    def factory():
        def predict(batch):
            (calls / f"{len(list(calls.iterdir()))}").touch()
            return ["Dog" if s == "woof" else None for s in batch["subject"]]

        return predict

    sample = spark.createDataFrame(
        [("1", "pets", "Dog", "IA", "woof"), ("2", "pets", "Cat", "IA", "woof"), ("3", "pets", "Cat", "IA", "?")],
        "case_id string, domain string, original_category string, original_method string, subject string",
    ).coalesce(1)
    engine = CallableEngine(factory, retries=0)
    rows = ev.result_rows(ev.evaluate(sample, [PETS], engine))
    run = ev.write_results(rows, str(tmp_path / "out"))
    assert (run.total, run.matches, run.failures) == (3, 1, 1) and run.rows_per_second > 0
    assert spark.read.json(str(tmp_path / "out")).count() == 3
    n_calls = len(list(calls.iterdir()))
    nothing = ev.write_results(rows.filter("false"), str(tmp_path / "none"))
    assert (nothing.total, nothing.matches, nothing.failures) == (0, 0, 0)
    assert n_calls <= 3  # one pass: the whole batch, then its failing half
