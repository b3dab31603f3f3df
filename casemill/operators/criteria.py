"""What an engine is asked: choice criteria (C3, C4), choice requests and prompts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemill import fixed_values as fixed
from casemill.functions.text import bullet_list, clip, display_name, fill_template
from casemill.operators.taxonomy import Domain, by_domain


def _category_text(domain: str, category: str) -> str:
    lowered = category.lower()
    for words, text in fixed.CATEGORY_TEXT_BY_WORD.get(domain, ()):
        if any(word in lowered for word in words):
            return text
    template = fixed.CATEGORY_TEXT.get(domain, fixed.CATEGORY_TEXT_OTHER)
    return template.format(category=category, lowered=lowered)


def choice_criteria(domain: Domain, closed: bool = False) -> list[tuple[str, str]]:
    """The choices of a domain with their descriptions, ``NO_APLICA`` first.

    ``closed=True`` leaves ``NO_APLICA`` out (C4, the evaluation's closed world).
    """
    key = domain.name.lower().strip()
    refusal = fixed.NOT_APPLICABLE_TEXT.get(key, fixed.NOT_APPLICABLE_TEXT_OTHER)
    choices = [(c, _category_text(key, c)) for c in domain.categories]
    if closed:
        return choices
    return [(fixed.NOT_APPLICABLE, refusal.format(domain=display_name(domain.name))), *choices]


def choice_requests(
    texts: DataFrame,
    domains: Sequence[Domain],
    closed: bool = False,
    max_chars: int | None = None,
) -> DataFrame:
    """C3/C4 + X4: the request for each ``(case_id, domain, subject)`` row.

    The criteria are constants of the domain, so they enter the plan as literals.
    ``max_chars`` clips the text to an engine's window (``CHOICE_CHARS``).
    """
    question = fixed.CLOSED_CHOICE_INSTRUCTIONS if closed else fixed.CHOICE_INSTRUCTIONS

    def criteria(d: Domain) -> Column:
        pairs = [F.lit(part) for pair in choice_criteria(d, closed) for part in pair]
        return F.create_map(*pairs)

    domain = F.col("domain")
    return texts.select(
        "case_id",
        "domain",
        clip(F.col("subject"), max_chars).alias("state"),
        by_domain(
            domain, {d.name: F.lit(question.format(domain=display_name(d.name))) for d in domains}
        ).alias("instructions"),
        by_domain(domain, {d.name: criteria(d) for d in domains}).alias("criteria"),
    )


def build_prompts(
    texts: DataFrame, domains: Sequence[Domain], max_chars: int | None = None
) -> DataFrame:
    """The prompt for each ``(case_id, domain, subject)`` row; the text goes in last.

    ``max_chars`` clips the text to an engine's window (``PROMPT_CHARS``).
    """
    text = clip(F.col("subject"), max_chars)

    def prompt(d: Domain) -> Column:
        name = display_name(d.name)
        values = {
            "clase_upper": name.upper(),
            "clase": name,
            "categories_list": bullet_list(d.categories),
        }
        return fill_template(d.prompt_template, values, "asunto", text)

    prompts = {d.name: prompt(d) for d in domains if d.prompt_template}
    return texts.select(
        "case_id", "domain", by_domain(F.col("domain"), prompts).cast("string").alias("prompt")
    )
