import pytest
from conftest import as_set, plan_of

from casemill.operators import cascade
from casemill.operators.answers import normalise_choice, normalise_generated
from casemill.operators.engines import CallableEngine, TermRules, TextModel
from casemill.operators.status import seed_status
from casemill.operators.taxonomy import Domain, shipped_domains
from casemill.schema import STATUS

PETS = Domain("pets", ("Dog", "Cat"), ("dog", "c_t"))
NOISE = Domain("noise", ("Bar", "Street"))
DOMAINS = [PETS, NOISE]
RULES = TermRules({"pets": {"Dog": ["dog", "puppy"], "Cat": ["cat"]}, "noise": {}})


def normalised(spark, function, answers, domains, domain):
    df = spark.createDataFrame([(domain, a) for a in answers], "domain string, answer string")
    return [r.answer for r in function(df, domains).collect()]


def test_generated_answers(spark):
    answers = ["Respuesta: Negación de citas médicas.", "no aplica", "algo", "", " \n", None,
               "creo que NO_APLICA otros", "OTROS"]
    assert normalised(spark, normalise_generated, answers, shipped_domains(), "salud") == [
        "Negación de citas médicas", "NO_APLICA", "NO_APLICA", None, None, None, "NO_APLICA", "Otros",
    ]


def test_choice_answers(spark):
    answers = ["Otros", "otros", "creo: Otros!", "NO_APLICA", "no_aplica", "", None]
    assert normalised(spark, normalise_choice, answers, shipped_domains(), "salud") == [
        "Otros", "Otros", "Otros", "NO_APLICA", "NO_APLICA", None, None,
    ]


def test_first_category_wins(spark):
    domains = [Domain("d", ("Ruido", "Ruido por vecinos"))]
    for function in (normalise_generated, normalise_choice):
        assert normalised(spark, function, ["Ruido por vecinos"], domains, "d") == ["Ruido"]


def test_blank_rows_are_finished(make_cases, make_status):
    cases = make_cases(("1", None), ("2", "  "), ("3", "\t"), ("4", "x"), ("5", ""))
    rows = [("pets", str(i), None, False, None) for i in range(1, 7)]
    rows.append(("noise", "1", "Bar", True, "IA"))
    done = cascade.mark_blank(make_status(*rows), cases)
    assert as_set(done.filter("processed"), "domain", "case_id", "category", "method") == {
        ("pets", "1", None, "VACIO"),
        ("pets", "2", None, "VACIO"),
        ("pets", "5", None, "VACIO"),
        ("noise", "1", "Bar", "IA"),
    }
    assert done.count() == 7  # "6" has no case and stays


def test_keyword_filter(make_cases, make_status):
    cases = make_cases(("1", "A DOG"), ("2", "cot"), ("3", "bird"), ("4", None), ("5", ""))
    rows = [(d, str(i), None, False, None) for d in ("pets", "noise") for i in range(1, 6)]
    done = cascade.mark_no_keyword(make_status(*rows), cases, DOMAINS)
    assert as_set(done.filter("processed"), "domain", "case_id", "method") == {
        ("pets", "3", "KEYWORDS"),
        ("pets", "5", "KEYWORDS"),
    }


def test_keyword_filter_without_keywords(make_cases, make_status):
    rows = make_status(("noise", "1", None, False, None))
    done = cascade.mark_no_keyword(rows, make_cases(("1", "bird")), [NOISE])
    assert as_set(done) == as_set(rows)


def test_outcomes(spark, make_status):
    rows = make_status(
        *[("pets", str(i), None, False, None) for i in range(3)], ("pets", "3", "Cat", True, "IA")
    )
    answers = spark.createDataFrame(
        [("0", "pets", "Dog"), ("1", "pets", "NO_APLICA"), ("2", "pets", None), ("3", "pets", "Dog")],
        "case_id string, domain string, answer string",
    )
    once = cascade.apply_outcomes(rows, answers, "IA")
    expected = {
        ("pets", "0", "Dog", True, "IA"),
        ("pets", "1", None, True, "IA"),
        ("pets", "2", None, False, None),
        ("pets", "3", "Cat", True, "IA"),
    }
    assert as_set(once) == expected
    assert as_set(cascade.apply_outcomes(once, answers, "IA")) == expected


TEXTS = [
    ("1", "my dog and puppy meet a cat"),
    ("2", "cat dog"),
    ("3", "a bar in the street"),
    ("4", "nothing"),
    ("5", None),
    ("6", " "),
    ("7", "\t"),
    ("8", "street cat"),
]


@pytest.mark.parametrize("keyword_filter", [False, True])
def test_all_cascades_agree(spark, make_cases, keyword_filter):
    """One-scan classification, the joined form and the step-by-step form give the same rows."""
    cases = make_cases(*TEXTS)
    seeded = seed_status(cases, ["pets", "noise"])
    fresh = cascade.classify_new(cases, DOMAINS, RULES, keyword_filter)
    joined = cascade.classify_pending(seeded, cases, DOMAINS, RULES, keyword_filter)
    stepwise = cascade.classify_in_passes(seeded, cases, DOMAINS, RULES, 1, keyword_filter)
    columns = seeded.columns
    assert as_set(fresh, *columns) == as_set(joined, *columns)
    found = {(d, k): (c, m) for d, k, c, _, m in as_set(fresh, *columns)}
    assert found["pets", "1"] == ("Dog", "IA")
    assert found["pets", "2"] == ("Dog", "IA")  # a tie goes to the earlier category
    assert found["noise", "3"] == ("Bar", "IA")
    assert found["pets", "4"] == (None, "KEYWORDS" if keyword_filter else "IA")
    assert found["pets", "5"] == found["noise", "6"] == (None, "VACIO")
    assert as_set(stepwise, *columns) == as_set(fresh, *columns)


def test_new_cases_need_no_shuffle(make_cases):
    plan = plan_of(cascade.classify_new(make_cases(*TEXTS), DOMAINS, RULES))
    assert "Exchange" not in plan and "Join" not in plan


def test_texts_stay_out_of_the_join(spark, tmp_path, make_cases, make_status):
    """Only verdicts meet the status rows, so no exchange carries the subject."""
    make_cases(*TEXTS).write.parquet(str(tmp_path / "c"))
    cases = spark.read.parquet(str(tmp_path / "c"))
    status = make_status(("pets", "1", None, False, None))
    for df in (
        cascade.classify_pending(status, cases, DOMAINS, RULES),
        cascade.mark_blank(status, cases),
        cascade.mark_no_keyword(status, cases, DOMAINS),
    ):
        text = df._jdf.queryExecution().optimizedPlan().toString()
        join = text.index("Join")
        first = text[join:].index("Project")
        assert "subject" not in text[join : join + first]


def test_lower_case_is_computed_once(spark, tmp_path, make_cases):
    make_cases(*TEXTS).write.parquet(str(tmp_path / "c"))
    fresh = cascade.classify_new(spark.read.parquet(str(tmp_path / "c")), DOMAINS, RULES)
    assert fresh._jdf.queryExecution().optimizedPlan().toString().count("lower(") == 1


def test_processed_rows_are_left_alone(make_cases, make_status):
    rows = make_status(("pets", "1", "Cat", True, "X"), ("pets", "gone", None, False, None))
    done = cascade.classify_pending(rows, make_cases(*TEXTS), DOMAINS, RULES)
    assert as_set(done) == as_set(rows)


def test_only_pending_rows_meet_the_verdicts(spark, tmp_path, make_cases, make_status):
    rows = [("pets", "1", "Cat", True, "IA"), ("pets", "2", None, False, None)]
    make_status(*rows).write.parquet(f"{tmp_path}/status")
    status = spark.read.schema(STATUS).parquet(f"{tmp_path}/status")
    cases = make_cases(("1", "a dog"), ("2", "a dog"))
    judged = cascade.classify_pending(status, cases, DOMAINS, TermRules({}))
    assert as_set(judged) == {rows[0], ("pets", "2", "Dog", True, "IA")}
    plan = plan_of(judged)
    union, joined = plan.index("Union"), plan.index("Join")
    assert union < joined and "EqualNullSafe(processed,false)" in plan[joined:]


def test_rule_scores(make_cases):
    texts = make_cases(*TEXTS).selectExpr("case_id", "subject", "array('pets') AS domains")
    rows = {r.case_id: r for r in RULES.score(texts, DOMAINS).collect()}
    assert rows["1"].answer == "Dog" and rows["1"].confidence == 2 / 3
    assert rows["1"].margin == pytest.approx(1 / 3)
    assert rows["4"].answer == "NO_APLICA" and rows["4"].probabilities["NO_APLICA"] == 1.0
    closed = TermRules(RULES.terms, closed=True)
    rows = {r.case_id: r for r in closed.score(texts, DOMAINS).collect()}
    assert (rows["4"].answer, rows["4"].confidence, rows["4"].margin) == ("Dog", 0.5, 0.0)
    assert "NO_APLICA" not in rows["4"].probabilities


def flaky():
    """A factory of a scorer that fails on its first call, and always on the word "street"."""

    def factory():
        state = {"calls": 0}

        def predict(batch):
            state["calls"] += 1
            if state["calls"] == 1:
                raise ConnectionError("first call")
            if batch["subject"].str.contains("street").any():
                raise ValueError("street is too hard")
            chances = {"Dog": 0.9, "Cat": 0.1}
            return [
                {"answer": "Dog", "confidence": 0.9, "margin": 0.8, "probabilities": chances}
                for _ in range(len(batch))
            ]

        return predict

    return factory


def test_callable_engine_retries_and_isolates_rows(make_cases):
    texts = make_cases(*TEXTS).filter("trim(subject) <> ''").coalesce(1)
    texts = texts.selectExpr("case_id", "subject", "array('pets') AS domains")
    engine = CallableEngine(flaky(), retries=1, wait_s=0.0)
    rows = {r.case_id: r for r in engine.score(texts, DOMAINS).collect()}
    assert rows["1"].answer == "Dog" and rows["1"].probabilities == {"Dog": 0.9, "Cat": 0.1}
    assert rows["1"].latency_s >= 0 and rows["1"].error is None
    assert rows["3"].answer is None and rows["3"].error == "street is too hard"
    assert rows["3"].confidence is None
    assert {k for k, r in rows.items() if r.answer is None} == {"3", "8"}


def test_wrong_number_of_answers_is_a_failure(make_cases):
    engine = CallableEngine(lambda: lambda batch: [], retries=0, wait_s=0.0)
    texts = make_cases(("1", "x")).selectExpr("case_id", "subject", "array('pets') AS domains")
    assert "0 answers" in engine.score(texts, DOMAINS).head().error


def test_failures_stay_pending(make_cases):
    cases = make_cases(*TEXTS)
    engine = CallableEngine(flaky(), retries=1, wait_s=0.0, concurrency=2)
    done = cascade.classify_in_passes(seed_status(cases, ["pets"]), cases, [PETS], engine)
    assert as_set(done.filter("NOT processed"), "case_id") == {("3",), ("8",)}
    assert as_set(done.filter("method = 'VACIO'"), "case_id") == {("5",), ("6",)}


def test_no_progress_stops_after_one_pass(spark, make_cases):
    passes = []

    def materialise(df):
        passes.append(1)
        return df.cache()

    engine = CallableEngine(lambda: lambda batch: [None] * len(batch))
    cases = make_cases(("1", "x"), ("2", "y"))
    done = cascade.classify_in_passes(
        seed_status(cases, ["pets"]), cases, [PETS], engine, max_passes=5, materialise=materialise
    )
    assert len(passes) == 2  # the waiting texts, and one pass
    assert done.filter("processed").count() == 0


def test_filters_run_below_the_python_step(spark, tmp_path, make_cases):
    make_cases(*TEXTS).write.parquet(str(tmp_path / "c"))
    cases = spark.read.parquet(str(tmp_path / "c"))
    engine = CallableEngine(lambda: lambda batch: ["Dog"] * len(batch))
    texts = cascade.pending_texts(seed_status(cases, ["pets"]), cases)
    plan = engine.score(texts, DOMAINS)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("MapInPandas") < plan.index("trim(subject")
    assert "Join Inner" in plan and "Cartesian" not in plan


def test_prompts_reach_a_generative_engine(make_cases):
    from casemill.operators.criteria import build_prompts

    domain = Domain("pets", ("Dog",), (), "Is it {categories_list}? {asunto}")
    seen = CallableEngine(
        lambda: lambda batch: [f"Respuesta: {p}" for p in batch["prompt"]],
        normalise=normalise_generated,
        prepare=build_prompts,
    )
    cases = make_cases(("1", "woof"))
    done = cascade.classify_in_passes(seed_status(cases, ["pets"]), cases, [domain], seen)
    assert as_set(done, "category", "method") == {("Dog", "IA")}


def test_text_model_learns_and_serves_all_domains(make_cases, make_status):
    cases = make_cases(
        *[(f"d{i}", "wuff bone walk") for i in range(5)],
        *[(f"c{i}", "purr mouse sofa") for i in range(5)],
        *[(f"n{i}", "tax form office") for i in range(5)],
        ("x", "bone walk please"), ("y", "sofa purr"), ("z", "office tax form"),
    )
    label = {"d": "Dog", "c": "Cat", "n": None}
    rows = [("pets", f"{k}{i}", c, True, "IA") for k, c in label.items() for i in range(5)]
    rows += [("noise", f"{k}{i}", "Bar" if k == "n" else None, True, "IA") for k in label for i in range(5)]
    model = TextModel.fit(make_status(*rows), cases)
    texts = cases.filter("length(case_id) = 1").selectExpr(
        "case_id", "subject", "array('pets', 'noise') AS domains"
    )
    got = {(r.case_id, r.domain): r for r in model.score(texts, DOMAINS).collect()}
    assert {k: r.answer for k, r in got.items()} == {
        ("x", "pets"): "Dog", ("y", "pets"): "Cat", ("z", "pets"): "NO_APLICA",
        ("x", "noise"): "NO_APLICA", ("y", "noise"): "NO_APLICA", ("z", "noise"): "Bar",
    }
    for r in got.values():
        ranked = sorted(r.probabilities.values(), reverse=True)
        assert sum(ranked) == pytest.approx(1.0)
        assert r.confidence == ranked[0] and r.margin == pytest.approx(ranked[0] - ranked[1])
    unknown = model.score(texts.selectExpr("case_id", "subject", "array('new') AS domains"),
                          [Domain("new", ("A",))])
    assert unknown.filter("answer IS NULL").count() == 3


def test_text_model_equals_plain_counts(spark, make_cases, make_status):
    """Scores from counts in Python: add-one smoothing over the exact shared vocabulary."""
    import math
    import random
    import re

    rng = random.Random(4)
    vocabulary = ["Été", "größe", "x1", "alpha", "beta", "gamma", "12", "日本"]
    texts = {f"t{i}": " ".join(rng.choices(vocabulary, k=rng.randint(0, 9))) + "!" for i in range(40)}
    texts["new"] = "unseen words only"
    labels = {(d, k): rng.choice([*c, None]) for d, c in (("pets", ("Dog", "Cat")), ("noise", ("Bar",)))
              for k in list(texts)[:30]}
    status = make_status(*[(d, k, c, True, "IA") for (d, k), c in labels.items()])
    cases = make_cases(*texts.items())
    model = TextModel.fit(status, cases)
    asked = cases.selectExpr("case_id", "subject", "array('pets', 'noise') AS domains")
    got = {(r.case_id, r.domain): r for r in model.score(asked, DOMAINS).collect()}

    words = {k: re.findall(r"\w+", t.lower()) for k, t in texts.items()}
    known = {w for k in list(texts)[:30] for w in words[k]}
    for (case, domain), r in got.items():
        scores = {}
        for label in sorted({v or "NO_APLICA" for (d, _), v in labels.items() if d == domain}):
            own = [k for (d, k), v in labels.items() if d == domain and (v or "NO_APLICA") == label]
            said = [w for k in own for w in words[k]]
            total = sum(d == domain for d, _ in labels)
            scores[label] = math.log(len(own) / total) + sum(
                math.log((said.count(w) + 1) / (len(said) + len(known)))
                for w in words[case] if w in known
            )
        whole = sum(map(math.exp, scores.values()))
        assert r.answer == max(scores, key=scores.get)
        assert r.probabilities == pytest.approx(
            {k: math.exp(v) / whole for k, v in scores.items()}, abs=1e-4
        )


def test_text_model_of_nothing(spark, make_cases, make_status):
    cases = make_cases(("1", "a"), ("2", None))
    model = TextModel.fit(make_status().filter("false"), cases)
    asked = cases.selectExpr("case_id", "subject", "array('pets') AS domains")
    assert as_set(model.score(asked, DOMAINS), "case_id", "answer") == {("1", None), ("2", None)}
