"""The benchmark tables read as cases, status rows, taxonomy and stored labels.

``orders`` are the cases, the document with the same number is the subject, the first shipping
date is the registration date. Orders still open (``O``) count as loaded but not yet classified.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casemill.fixed_values import NOT_APPLICABLE
from casemill.operators.cascade import classify_new
from casemill.operators.engines import TermRules
from casemill.operators.status import seed_status
from casemill.operators.taxonomy import Domain

_TEMPLATE = """Domain: {clase_upper} ({clase})
{categories_list}
Answer with one of these or NO_APLICA.
Text: "{asunto}"
Respuesta:"""

DOMAINS = [
    Domain(
        "licence",
        ("GNU General Public License", "MIT License", "Apache License", "License"),
        ("license",),
        _TEMPLATE,
    ),
    Domain("contact", ("Email", "Phone"), ("@", "+"), _TEMPLATE),
    Domain(
        "abusive_words",
        ("Insult", "Contempt"),
        ("idiot", "moron", "loser", "clown", "stupid", "trash", "scum", "worth_ess",
         "pathetic", "disg%ting"),
        _TEMPLATE,
    ),
    Domain("language", ("English", "German", "Spanish", "French"), (), _TEMPLATE),
]
DOMAIN_NAMES = [d.name for d in DOMAINS]

TERMS = {
    "contact": {"Email": ["@"], "Phone": ["+"]},
    "abusive_words": {
        "Insult": ["idiot", "moron", "loser", "clown", "stupid"],
        "Contempt": ["trash", "scum", "worthless", "pathetic", "disgusting"],
    },
    "language": {
        "English": [" the ", " and ", " with "],
        "German": [" der ", " und ", " nicht "],
        "Spanish": [" los ", " el ", " para "],
        "French": [" les ", " des ", " pour "],
    },
}
RULES = TermRules(TERMS)
CLOSED_RULES = TermRules(TERMS, closed=True)

# A weaker second engine to measure against the stored categories: one term per category.
SECOND_RULES = TermRules(
    {
        "contact": {"Email": ["@mail3"], "Phone": ["+"]},
        "abusive_words": {"Insult": ["idiot"], "Contempt": ["trash"]},
        "language": {
            "English": [" the "],
            "German": [" der "],
            "Spanish": [" los "],
            "French": [" les "],
        },
    },
    closed=True,
)

LANGUAGE_LABELS = {"en": "English", "de": "German", "es": "Spanish", "fr": "French"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cases(
    spark: SparkSession, sf_dir: str, subject: bool = True, register_date: bool = True
) -> DataFrame:
    """The master table; a report that needs no subject or no register date skips their join."""
    orders = table(spark, sf_dir, "orders")
    columns = [
        F.col("o_orderkey").cast("string").alias("case_id"),
        F.col("o_orderdate").cast("string").alias("entry_date"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderpriority").alias("priority"),
    ]
    joined = orders
    if subject:
        documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
        # Dealt by the join's key once, so that the text work has tasks and nothing moves twice.
        documents = documents.repartition("doc_id")
        joined = joined.join(documents, joined.o_orderkey == documents.doc_id, "left")
        columns += [F.col("text").alias("subject"), "lang", "source"]
    if register_date:
        shipped = (
            table(spark, sf_dir, "lineitem")
            .groupBy("l_orderkey")
            .agg(F.min("l_shipdate").alias("first_ship"))
        )
        joined = joined.join(shipped, joined.o_orderkey == shipped.l_orderkey, "left")
        columns.append(F.col("first_ship").cast("string").alias("register_date"))
    return joined.select(*columns)


def texts_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases with the columns that the cascade reads."""
    return cases(spark, sf_dir, register_date=False)


def status(spark: SparkSession, sf_dir: str, keyword_filter: bool = False) -> DataFrame:
    """Closed and partly shipped orders classified, open orders pending."""
    loaded = texts_of(spark, sf_dir)
    is_open = F.col("order_status") == "O"
    fresh = cases(spark, sf_dir, subject=False, register_date=False).filter(is_open)
    done = classify_new(loaded.filter(~is_open), DOMAINS, RULES, keyword_filter)
    return done.unionByName(seed_status(fresh, DOMAIN_NAMES))


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every case classified."""
    return classify_new(texts_of(spark, sf_dir), DOMAINS, RULES)


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored labels for an evaluation: each document's language, and one from every label row."""
    documents = table(spark, sf_dir, "documents").repartition("doc_id")
    language = F.create_map(*[F.lit(x) for pair in LANGUAGE_LABELS.items() for x in pair])
    by_language = documents.select(
        F.col("doc_id").cast("string").alias("case_id"),
        F.lit("language").alias("domain"),
        language[F.col("lang")].alias("original_category"),
        F.lit("LABEL").alias("original_method"),
        F.col("text").alias("subject"),
    )
    labels = table(spark, sf_dir, "labels")
    grade = (
        F.when(F.col("toxic") == 1, "Insult")
        .when(F.col("quality") == 0, "Contempt")
        .otherwise(NOT_APPLICABLE)
    )
    by_label = documents.join(labels, "doc_id").select(
        F.col("doc_id").cast("string").alias("case_id"),
        F.lit("abusive_words").alias("domain"),
        grade.alias("original_category"),
        F.lit("LABEL").alias("original_method"),
        F.col("text").alias("subject"),
    )
    return by_language.unionByName(by_label)
