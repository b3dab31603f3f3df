import pytest
from conftest import as_set
from pyspark.sql import functions as F

from casemill import fixed_values as fixed
from casemill.functions import dates, numbers, text
from casemill.schema import normalise_headers
from casemill.operators.criteria import build_prompts, choice_criteria, choice_requests
from casemill.operators.taxonomy import Domain, shipped_domains


def test_headers():
    given = ["﻿Número petición", "Fecha-Ingreso", "Tel. / Fax", "Año", "Año", " año_1 "]
    assert normalise_headers(given) == [
        "numero_peticion", "fecha_ingreso", "tel___fax", "ano", "ano_1", "ano_1_1",
    ]


@pytest.mark.parametrize(
    ("value", "blank"),
    [(None, True), ("", True), ("   ", True), ("\t", False), ("x", False), (" x ", False)],
)
def test_blank_trims_spaces_only(spark, value, blank):
    row = spark.createDataFrame([(value,)], "t string").select(
        text.is_blank(F.col("t")), text.has_text(F.col("t"))
    )
    assert tuple(row.head()) == (blank, not blank)


def test_strip_removes_all_white_space(spark):
    given = "　\x1f\t a b \n "
    row = spark.createDataFrame([(given,)], "t string").select(text.strip_all(F.col("t"))).head()
    assert row[0] == given.strip() == "a b"


def test_clip_cuts_then_strips(spark):
    df = spark.createDataFrame([("x" * 700,), ("y" * 900,), ("a" * 599 + "  b",)], "t string")
    lengths = df.select(
        F.length(text.clip(F.col("t"), fixed.PROMPT_CHARS)),
        F.length(text.clip(F.col("t"), fixed.CHOICE_CHARS)),
        F.length(text.clip(F.col("t"), None)),
    )
    assert as_set(lengths) == {(600, 700, 700), (600, 800, 900), (599, 602, 602)}


def test_keywords_are_accent_sensitive_and_know_wildcards(spark):
    keywords = ["perro", "desnutricion", "a_b"]
    given = ["UN PERRO", "desnutrición", "DESNUTRICION", None, "axb", "ab"]
    df = spark.createDataFrame([(t,) for t in given], "t string")
    hit = text.any_keyword(F.lower("t"), keywords)
    assert [r[0] for r in df.select(hit).collect()] == [True, False, True, None, True, False]


def test_months(spark):
    df = spark.createDataFrame([("2026-03-15",), ("",), (None,), ("2026",)], "d string")
    labels = [r[0] for r in df.select(dates.month_label(F.col("d"))).collect()]
    assert labels == ["2026-03", "Sin fecha", "Sin fecha", "2026"]


def test_either_date_selects(spark):
    df = spark.createDataFrame(
        [("2026-03-30", "2026-04-02"), (None, "2026-03-01"), (None, None)], "a string, b string"
    )

    def hits(prefix):
        flag = dates.in_periods([prefix], F.col("a"), F.col("b"))
        return [r[0] for r in df.select(flag).collect()]

    assert hits("2026-03") == [True, True, False]
    assert hits("2026-04") == [True, False, False]
    assert dates.months_of_year(2023, 3, 10)[0] == "2023-03"
    assert len(dates.months_of_year(2023, 3, 10)) == 8


def test_percent_of_nothing_is_zero(spark):
    df = spark.createDataFrame([(0, 0), (1, 3)], "n long, total long")
    pct = numbers.percent(F.col("n"), F.col("total"))
    rows = df.select(pct, numbers.percent_text(pct, 4), numbers.thousands(F.lit(3881396))).collect()
    assert tuple(rows[0]) == (0.0, "0.0000%", "3,881,396")
    assert rows[1][1] == "33.3333%"


def test_template_does_not_expand_the_text(spark):
    domain = Domain("mi_tema", ("Uno", "Dos"), (), "{clase_upper}|{clase}|{categories_list}|{{x}}|{asunto}!")
    df = spark.createDataFrame([("1", "mi_tema", " {clase} { ")], "case_id string, domain string, subject string")
    prompt = build_prompts(df, [domain]).head().prompt
    assert prompt == "MI TEMA|mi tema|- Uno\n- Dos|{x}|{clase} {!"


def test_prompt_window(spark):
    domain = Domain("d", ("Uno",), (), "{asunto}")
    df = spark.createDataFrame([("1", "d", "z" * 700)], "case_id string, domain string, subject string")
    assert len(build_prompts(df, [domain], fixed.PROMPT_CHARS).head().prompt) == 600
    assert len(build_prompts(df, [domain]).head().prompt) == 700


def test_shipped_prompt(spark):
    domains = shipped_domains()
    df = spark.createDataFrame(
        [("1", "maltrato_animal", "Un perro encerrado")],
        "case_id string, domain string, subject string",
    )
    prompt = build_prompts(df, domains).head().prompt
    assert "situaciones de 'MALTRATO ANIMAL'" in prompt
    assert "responde con:\n- Maltrato Animal\n" in prompt
    assert prompt.endswith('Asunto: "Un perro encerrado"\nRespuesta:')


def test_shipped_criteria():
    by_name = {d.name: d for d in shipped_domains()}
    health = dict(choice_criteria(by_name["salud"]))
    assert list(health)[0] == "NO_APLICA"
    assert health["NO_APLICA"] == "El asunto NO tiene ninguna relación con el sector salud ni atención médica."
    assert health["Negación de citas médicas"].startswith("Negación, falta de agenda")
    assert health["Otros"].startswith("Otras peticiones o quejas")
    noise = dict(choice_criteria(by_name["ruido"], closed=True))
    assert "NO_APLICA" not in noise and len(noise) == 10
    assert noise["Ruido por vecinos"] == "El asunto corresponde a quejas por ruido por vecinos."
    animals = dict(choice_criteria(by_name["maltrato_animal"]))
    assert animals["Maltrato Animal"].startswith("Denuncias o situaciones de maltrato")
    other = dict(choice_criteria(Domain("vias_rotas", ("Hueco",))))
    assert other == {
        "NO_APLICA": "El asunto NO está relacionado con vias rotas o corresponde a otros temas no pertinentes.",
        "Hueco": "El asunto corresponde específicamente a Hueco.",
    }


def test_choice_request(spark):
    df = spark.createDataFrame([("1", "ruido", "  bar  ")], "case_id string, domain string, subject string")
    row = choice_requests(df, shipped_domains()).head()
    assert row.state == "bar"
    assert "corresponde a ruido y seleccionar" in row.instructions
    assert len(row.criteria) == 11
