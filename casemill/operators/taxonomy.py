"""Topic domains: the configuration that drives seeding, filtering and classification."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill import fixed_values as fixed
from casemill.schema import TAXONOMY


@dataclass(frozen=True)
class Domain:
    """One topic: its categories in matching order, optional keywords and prompt template."""

    name: str
    categories: tuple[str, ...]
    keywords: tuple[str, ...] = ()
    prompt_template: str | None = None

    def __post_init__(self) -> None:
        if not self.categories:
            raise ValueError(f"domain {self.name!r} has no categories")


def shipped_domains() -> list[Domain]:
    """The three domains that come with the package."""
    return [
        Domain(
            name,
            tuple(categories),
            tuple(fixed.KEYWORDS.get(name, ())),
            fixed.PROMPT_TEMPLATES.get(name),
        )
        for name, categories in fixed.CATEGORIES.items()
    ]


def taxonomy_frame(spark: SparkSession, domains: Iterable[Domain]) -> DataFrame:
    rows = [(d.name, list(d.categories), list(d.keywords), d.prompt_template) for d in domains]
    return spark.createDataFrame(rows, TAXONOMY)


def parse_taxonomy(raw: DataFrame) -> DataFrame:
    """Categories and keywords stored as JSON arrays of strings."""
    return raw.select(
        "domain",
        F.from_json("categories", "array<string>").alias("categories"),
        F.coalesce(F.from_json("keywords", "array<string>"), F.array().cast("array<string>")).alias(
            "keywords"
        ),
        "prompt_template",
    )


def dump_taxonomy(taxonomy: DataFrame) -> DataFrame:
    """The reverse of :func:`parse_taxonomy`."""
    return taxonomy.select(
        "domain",
        F.to_json("categories").alias("categories"),
        F.to_json("keywords").alias("keywords"),
        "prompt_template",
    )


def load_domains(taxonomy: DataFrame, only: str | None = None) -> list[Domain]:
    """The configured domains, or one of them, ordered by name.

    A taxonomy is configuration that people write: a row per topic, which enter plans as literals.
    """
    chosen = taxonomy if only is None else taxonomy.filter(F.col("domain") == only)
    rows = chosen.orderBy("domain").collect()
    if only is not None and not rows:
        raise ValueError(f"no domain named {only!r}")
    return [
        Domain(r.domain, tuple(r.categories), tuple(r.keywords or ()), r.prompt_template)
        for r in rows
    ]


def upsert_taxonomy(stored: DataFrame, changes: DataFrame) -> DataFrame:
    """A domain in ``changes`` replaces the stored one or is added."""
    kept = stored.join(changes.select("domain"), "domain", "left_anti")
    return kept.unionByName(changes)


def by_domain(domain: Column, choices: dict[str, Column]) -> Column:
    """Pick the expression of the row's domain; NULL for a domain not listed."""
    branches: Sequence[tuple[str, Column]] = list(choices.items())
    if not branches:
        return F.lit(None)
    name, value = branches[0]
    picked = F.when(domain == name, value)
    for name, value in branches[1:]:
        picked = picked.when(domain == name, value)
    return picked
