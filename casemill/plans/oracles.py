"""The queries of ``queries`` in SQL, written apart from the Spark code, for checking results."""

from __future__ import annotations

CASES = """
cases AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) AS case_id, d.text AS subject, d.lang, d.source,
         CAST(o.o_orderdate AS VARCHAR) AS entry_date, CAST(s.first_ship AS VARCHAR) AS register_date,
         o.o_orderstatus AS order_status, o.o_orderpriority AS priority
  FROM orders o
  LEFT JOIN documents d ON o.o_orderkey = d.doc_id
  LEFT JOIN (SELECT l_orderkey, min(l_shipdate) AS first_ship FROM lineitem GROUP BY l_orderkey) s
    ON o.o_orderkey = s.l_orderkey
),
domains AS (
  SELECT unnest(['licence', 'contact', 'abusive_words', 'language']) AS domain
)"""

HITS = """
lowered AS (SELECT case_id, order_status, subject, lower(subject) AS t FROM cases),
hits AS (
  SELECT case_id, order_status, subject, t,
    contains(t, 'gnu general public license') AS gnu, contains(t, 'mit license') AS mit,
    contains(t, 'apache license') AS apache, contains(t, 'license') AS lic,
    contains(t, '@') AS email, contains(t, '+') AS phone,
    CAST(contains(t, 'idiot') AS INT) + CAST(contains(t, 'moron') AS INT)
      + CAST(contains(t, 'loser') AS INT) + CAST(contains(t, 'clown') AS INT)
      + CAST(contains(t, 'stupid') AS INT) AS insult,
    CAST(contains(t, 'trash') AS INT) + CAST(contains(t, 'scum') AS INT)
      + CAST(contains(t, 'worthless') AS INT) + CAST(contains(t, 'pathetic') AS INT)
      + CAST(contains(t, 'disgusting') AS INT) AS contempt,
    CAST(contains(t, ' the ') AS INT) + CAST(contains(t, ' and ') AS INT)
      + CAST(contains(t, ' with ') AS INT) AS en,
    CAST(contains(t, ' der ') AS INT) + CAST(contains(t, ' und ') AS INT)
      + CAST(contains(t, ' nicht ') AS INT) AS de,
    CAST(contains(t, ' los ') AS INT) + CAST(contains(t, ' el ') AS INT)
      + CAST(contains(t, ' para ') AS INT) AS es,
    CAST(contains(t, ' les ') AS INT) + CAST(contains(t, ' des ') AS INT)
      + CAST(contains(t, ' pour ') AS INT) AS fr,
    (t ILIKE '%license%') AS kw_licence,
    (t ILIKE '%@%' OR t ILIKE '%+%') AS kw_contact,
    (t ILIKE '%idiot%' OR t ILIKE '%moron%' OR t ILIKE '%loser%' OR t ILIKE '%clown%'
      OR t ILIKE '%stupid%' OR t ILIKE '%trash%' OR t ILIKE '%scum%' OR t ILIKE '%worth_ess%'
      OR t ILIKE '%pathetic%' OR t ILIKE '%disg%ting%') AS kw_abusive_words
  FROM lowered
),
verdicts AS (
  SELECT case_id, order_status, subject, 'licence' AS domain, kw_licence AS kw,
         CASE WHEN gnu THEN 'GNU General Public License' WHEN mit THEN 'MIT License'
              WHEN apache THEN 'Apache License' WHEN lic THEN 'License' END AS found FROM hits
  UNION ALL
  SELECT case_id, order_status, subject, 'contact', kw_contact,
         CASE WHEN email THEN 'Email' WHEN phone THEN 'Phone' END FROM hits
  UNION ALL
  SELECT case_id, order_status, subject, 'abusive_words', kw_abusive_words,
         CASE WHEN insult > 0 AND insult >= contempt THEN 'Insult'
              WHEN contempt > 0 THEN 'Contempt' END FROM hits
  UNION ALL
  SELECT case_id, order_status, subject, 'language', TRUE,
         CASE WHEN greatest(en, de, es, fr) = 0 THEN NULL
              WHEN en = greatest(en, de, es, fr) THEN 'English'
              WHEN de = greatest(en, de, es, fr) THEN 'German'
              WHEN es = greatest(en, de, es, fr) THEN 'Spanish'
              WHEN fr IS NOT NULL THEN 'French' END FROM hits
)"""

_METHOD = """CASE WHEN subject IS NULL OR trim(subject) = '' THEN 'VACIO' ELSE 'IA' END"""
_METHOD_KW = """CASE WHEN subject IS NULL OR trim(subject) = '' THEN 'VACIO'
                WHEN NOT kw THEN 'KEYWORDS' ELSE 'IA' END"""


def _outcomes(method: str, name: str = "outcomes") -> str:
    return f"""
{name} AS (
  SELECT domain, case_id, order_status, method, CASE WHEN method = 'IA' THEN found END AS category
  FROM (SELECT *, {method} AS method FROM verdicts)
)"""


def _status(name: str = "status", source: str = "outcomes") -> str:
    return f"""
{name} AS (
  SELECT domain, case_id,
         CASE WHEN order_status <> 'O' THEN category END AS category,
         order_status <> 'O' AS processed,
         CASE WHEN order_status <> 'O' THEN method END AS method
  FROM {source}
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


ON_CASES = _with(CASES)
ON_STATUS = _with(CASES, HITS, _outcomes(_METHOD), _status())
ON_STATUS_KW = _with(CASES, HITS, _outcomes(_METHOD_KW), _status())
BOTH = _with(
    CASES, HITS, _outcomes(_METHOD), _outcomes(_METHOD_KW, "outcomes_kw"), _status()
)

_MONTH = """(entry_date LIKE '1997-03%' OR register_date LIKE '1997-03%')"""
_MONTHS = " OR ".join(
    f"{d} LIKE '1998-{m:02d}%'" for d in ("entry_date", "register_date") for m in range(3, 11)
)
_ENTRY = "coalesce(nullif(substring(entry_date, 1, 7), ''), 'Sin fecha')"
_REGISTER = "coalesce(nullif(substring(register_date, 1, 7), ''), 'Sin fecha')"
_FILLED = "(subject IS NOT NULL AND trim(subject) <> '')"

INCOMING = """
stored AS (SELECT CAST(o_orderkey AS VARCHAR) AS case_id FROM orders WHERE o_orderstatus = 'F'),
mixed AS (
  SELECT CAST(d.doc_id AS VARCHAR) AS case_id, CAST(o.o_orderkey AS VARCHAR) AS origin
  FROM orders o LEFT JOIN documents d ON o.o_orderkey = d.doc_id
  UNION ALL
  SELECT CAST(l_orderkey AS VARCHAR),
         CAST(l_orderkey AS VARCHAR) || '/' || CAST(l_linenumber AS VARCHAR) FROM lineitem
)"""

READABLE = """
readable AS MATERIALIZED (
  SELECT case_id, subject FROM cases WHERE subject IS NOT NULL AND trim(subject) <> ''
),
texts AS (SELECT case_id, subject, domain FROM readable CROSS JOIN domains)"""

# The white space that a strip removes, as a character list for trim().
_SPACE = " || ".join(
    f"chr({n})"
    for n in [*range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239,
              8287, 12288]
)


def _strip(text: str) -> str:
    return f"trim({text}, {_SPACE})"


def _named(text: str) -> str:
    """The first category, in order, whose name occurs in the text."""
    return f"""CASE
      WHEN domain = 'licence' AND contains(lower({text}), 'gnu general public license') THEN 'GNU General Public License'
      WHEN domain = 'licence' AND contains(lower({text}), 'mit license') THEN 'MIT License'
      WHEN domain = 'licence' AND contains(lower({text}), 'apache license') THEN 'Apache License'
      WHEN domain = 'licence' AND contains(lower({text}), 'license') THEN 'License'
      WHEN domain = 'contact' AND contains(lower({text}), 'email') THEN 'Email'
      WHEN domain = 'contact' AND contains(lower({text}), 'phone') THEN 'Phone'
      WHEN domain = 'abusive_words' AND contains(lower({text}), 'insult') THEN 'Insult'
      WHEN domain = 'abusive_words' AND contains(lower({text}), 'contempt') THEN 'Contempt'
      WHEN domain = 'language' AND contains(lower({text}), 'english') THEN 'English'
      WHEN domain = 'language' AND contains(lower({text}), 'german') THEN 'German'
      WHEN domain = 'language' AND contains(lower({text}), 'spanish') THEN 'Spanish'
      WHEN domain = 'language' AND contains(lower({text}), 'french') THEN 'French'
      ELSE 'NO_APLICA' END"""


CHOICES = """
choices(domain, ord, category) AS (
  VALUES ('licence', 1, 'GNU General Public License'), ('licence', 2, 'MIT License'),
         ('licence', 3, 'Apache License'), ('licence', 4, 'License'),
         ('contact', 1, 'Email'), ('contact', 2, 'Phone'),
         ('abusive_words', 1, 'Insult'), ('abusive_words', 2, 'Contempt'),
         ('language', 1, 'English'), ('language', 2, 'German'), ('language', 3, 'Spanish'),
         ('language', 4, 'French')
),
described AS (
  SELECT domain, ord, category || ': El asunto corresponde específicamente a ' || category || '.' AS line
  FROM choices
  UNION ALL
  SELECT domain, 0, 'NO_APLICA: El asunto NO está relacionado con ' || replace(domain, '_', ' ')
         || ' o corresponde a otros temas no pertinentes.' FROM domains
)"""


def _requests(first: int, before: str, after: str) -> str:
    return (
        _with(CASES, READABLE, CHOICES)
        + f"""
SELECT t.case_id, c.domain, {_strip("t.subject")} AS state,
       '{before}' || replace(c.domain, '_', ' ') || '{after}' AS instructions, c.criteria
FROM readable t CROSS JOIN (
  SELECT domain, string_agg(line, chr(10) ORDER BY ord) AS criteria FROM described
  WHERE ord >= {first} GROUP BY domain
) c"""
    )


SHARES = """
labelled AS (
  SELECT CAST(doc_id AS VARCHAR) AS case_id, 'language' AS domain,
         CASE lang WHEN 'en' THEN 'English' WHEN 'de' THEN 'German' WHEN 'es' THEN 'Spanish'
                   WHEN 'fr' THEN 'French' END AS original_category
  FROM documents
  UNION ALL
  SELECT CAST(doc_id AS VARCHAR), 'abusive_words',
         CASE WHEN toxic = 1 THEN 'Insult' WHEN quality = 0 THEN 'Contempt' ELSE 'NO_APLICA' END
  FROM labels
),
counted AS (
  SELECT l.case_id, l.domain, l.original_category,
         CASE WHEN l.domain = 'language'
              THEN [{'c': 'English', 'ord': 1, 'n': h.en}, {'c': 'German', 'ord': 2, 'n': h.de},
                    {'c': 'Spanish', 'ord': 3, 'n': h.es}, {'c': 'French', 'ord': 4, 'n': h.fr}]
              ELSE [{'c': 'Insult', 'ord': 1, 'n': h.insult},
                    {'c': 'Contempt', 'ord': 2, 'n': h.contempt}] END AS counts
  FROM labelled l JOIN (
    SELECT CAST(doc_id AS VARCHAR) AS case_id,
    CAST(contains(lower(text), 'idiot') AS INT) + CAST(contains(lower(text), 'moron') AS INT)
      + CAST(contains(lower(text), 'loser') AS INT) + CAST(contains(lower(text), 'clown') AS INT)
      + CAST(contains(lower(text), 'stupid') AS INT) AS insult,
    CAST(contains(lower(text), 'trash') AS INT) + CAST(contains(lower(text), 'scum') AS INT)
      + CAST(contains(lower(text), 'worthless') AS INT)
      + CAST(contains(lower(text), 'pathetic') AS INT)
      + CAST(contains(lower(text), 'disgusting') AS INT) AS contempt,
    CAST(contains(lower(text), ' the ') AS INT) + CAST(contains(lower(text), ' and ') AS INT)
      + CAST(contains(lower(text), ' with ') AS INT) AS en,
    CAST(contains(lower(text), ' der ') AS INT) + CAST(contains(lower(text), ' und ') AS INT)
      + CAST(contains(lower(text), ' nicht ') AS INT) AS de,
    CAST(contains(lower(text), ' los ') AS INT) + CAST(contains(lower(text), ' el ') AS INT)
      + CAST(contains(lower(text), ' para ') AS INT) AS es,
    CAST(contains(lower(text), ' les ') AS INT) + CAST(contains(lower(text), ' des ') AS INT)
      + CAST(contains(lower(text), ' pour ') AS INT) AS fr
    FROM documents
  ) h ON l.case_id = h.case_id
),
options AS (
  SELECT case_id, domain, original_category, o.c AS choice, o.ord AS ord, o.n AS n,
         sum(o.n) OVER w AS total, count(*) OVER w AS k
  FROM (SELECT case_id, domain, original_category, unnest(counts) AS o FROM counted)
  WINDOW w AS (PARTITION BY case_id, domain)
),
ranked AS (
  SELECT *, CASE WHEN total = 0 THEN 1.0 / CAST(k AS DOUBLE)
                 ELSE CAST(n AS DOUBLE) / CAST(total AS DOUBLE) END AS p,
         row_number() OVER (PARTITION BY case_id, domain ORDER BY n DESC, ord) AS rn,
         row_number() OVER (PARTITION BY case_id, domain ORDER BY n DESC, choice) AS rn_name
  FROM options
),
evaluated AS (
  SELECT case_id, domain, original_category,
         max(CASE WHEN rn = 1 THEN choice END) AS predicted,
         max(CASE WHEN rn = 1 THEN choice END) = original_category AS match,
         max(CASE WHEN rn = 1 THEN p END) AS confidence,
         max(CASE WHEN rn = 1 THEN p END) - max(CASE WHEN rn = 2 THEN p END) AS margin,
         string_agg(CASE WHEN rn_name <= 3 THEN choice END, '|' ORDER BY rn_name) AS top3
  FROM ranked GROUP BY case_id, domain, original_category
)"""

ON_EVALUATION = _with(SHARES)
_AGREEMENT = """count(*) AS total, count(*) FILTER (WHERE match) AS matches,
       round(CAST(count(*) FILTER (WHERE match) AS DOUBLE) / count(*) * 100, 2) AS agreement_pct"""

_SAMPLE = """
quotas(domain, category, quota) AS (
  VALUES ('licence', 'GNU General Public License', 5), ('licence', 'MIT License', 5),
         ('licence', 'Apache License', 5), ('contact', 'Email', 4), ('contact', 'Phone', 4),
         ('abusive_words', 'Insult', 12), ('abusive_words', 'Contempt', 12),
         ('language', 'English', 35), ('language', 'German', 35), ('language', 'Spanish', 23),
         ('language', 'French', 47)
),
drawn AS (
  SELECT o.case_id, o.domain, o.category, o.method, c.subject, q.quota,
         row_number() OVER (PARTITION BY o.domain, o.category
                            ORDER BY md5('7#' || o.case_id), o.case_id) AS rn
  FROM outcomes o JOIN quotas q ON o.domain = q.domain AND o.category = q.category
  JOIN cases c ON c.case_id = o.case_id
  WHERE c.subject IS NOT NULL AND trim(c.subject) <> ''
)"""

_EXPORT = (
    ON_STATUS[: -1]
    + """,
monthly AS (
  SELECT s.domain, substring(c.entry_date, 1, 7) AS year_month,
         count(*) FILTER (WHERE s.category IS NOT NULL) AS classified, count(*) AS total
  FROM status s JOIN cases c ON s.case_id = c.case_id
  WHERE c.entry_date IS NOT NULL AND trim(c.entry_date) <> ''
    AND length(substring(c.entry_date, 1, 7)) >= 7
  GROUP BY ALL
  UNION ALL
  SELECT s.domain, NULL, count(*) FILTER (WHERE s.category IS NOT NULL), count(*)
  FROM status s JOIN cases c ON s.case_id = c.case_id
  WHERE c.entry_date IS NOT NULL AND trim(c.entry_date) <> ''
    AND length(substring(c.entry_date, 1, 7)) >= 7
  GROUP BY s.domain
)
"""
)

ORACLES: dict[str, str] = {
    "load_insert_if_absent": """
SELECT case_id, l_linenumber, l_partkey, l_suppkey, l_quantity, entry_date FROM (
  SELECT CAST(l_orderkey AS VARCHAR) AS case_id, l_linenumber, l_partkey, l_suppkey, l_quantity,
         CAST(l_shipdate AS VARCHAR) AS entry_date,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_shipdate, l_partkey,
           l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax) AS rn
  FROM lineitem)
WHERE rn = 1 AND case_id NOT IN (
  SELECT CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderstatus = 'F')""",
    "load_accounting": _with(INCOMING)
    + """
SELECT processed, inserted, processed - inserted - rejected AS existing, rejected FROM (
  SELECT count(*) AS processed, count(*) FILTER (WHERE case_id IS NULL) AS rejected,
         count(DISTINCT CASE WHEN case_id NOT IN (SELECT case_id FROM stored) THEN case_id END)
           AS inserted
  FROM mixed)""",
    "load_rejects": _with(INCOMING)
    + "SELECT origin, 'missing_key' AS reject_reason FROM mixed WHERE case_id IS NULL",
    "seed_status": ON_CASES
    + """
SELECT domain, case_id, CAST(NULL AS VARCHAR) AS category, FALSE AS processed,
       CAST(NULL AS VARCHAR) AS method
FROM cases CROSS JOIN domains""",
    "sync_missing_status": ON_CASES
    + """
SELECT d.domain, c.case_id, CAST(NULL AS VARCHAR) AS category, FALSE AS processed,
       CAST(NULL AS VARCHAR) AS method
FROM cases c CROSS JOIN domains d
LEFT JOIN (
  SELECT case_id, domain FROM cases CROSS JOIN domains
  WHERE (order_status = 'F' AND domain IN ('licence', 'contact', 'abusive_words'))
     OR (order_status = 'P' AND domain = 'licence')
) s ON s.case_id = c.case_id AND s.domain = d.domain
WHERE s.case_id IS NULL""",
    "taxonomy_upsert": """
WITH old AS (
  SELECT source AS domain, string_agg(DISTINCT lang, '|' ORDER BY lang) AS categories,
         string_agg(DISTINCT lang, '|' ORDER BY lang) AS keywords
  FROM documents GROUP BY source),
new AS (
  SELECT source AS domain,
         string_agg(DISTINCT 'quality ' || quality, '|' ORDER BY 'quality ' || quality) AS categories,
         string_agg(DISTINCT lang, '|' ORDER BY lang) AS keywords
  FROM documents JOIN labels USING (doc_id) GROUP BY source)
SELECT * FROM new UNION ALL SELECT * FROM old WHERE domain NOT IN (SELECT domain FROM new)""",
    "taxonomy_json": """
SELECT source AS domain, to_json(list(DISTINCT lang ORDER BY lang))::VARCHAR AS categories,
       to_json(list(DISTINCT lang ORDER BY lang))::VARCHAR AS keywords
FROM documents GROUP BY source""",
    "late_method_column": ON_STATUS
    + "SELECT domain, case_id, category, processed, CAST(NULL AS VARCHAR) AS method FROM status",
    "pending_slice": ON_CASES
    + """
SELECT case_id, subject, 'abusive_words|contact|language|licence' AS domains FROM cases
WHERE order_status = 'O' AND subject IS NOT NULL AND trim(subject) <> ''
ORDER BY case_id LIMIT 50""",
    "orphan_status": ON_CASES
    + f"""
SELECT domain, count(*) AS orphans FROM cases CROSS JOIN domains
WHERE ({_MONTHS}) AND domain IN ('abusive_words', 'language') GROUP BY domain""",
    "cases_per_month": ON_CASES
    + f"SELECT {_ENTRY} AS month, count(*) AS total FROM cases GROUP BY 1 ORDER BY 1",
    "cases_per_register_month": ON_CASES
    + f"SELECT {_REGISTER} AS month, count(*) AS total FROM cases GROUP BY 1 ORDER BY 1",
    "subject_coverage": ON_CASES
    + f""", n AS (
  SELECT count(*) FILTER (WHERE {_FILLED}) AS filled, count(*) AS total FROM cases)
SELECT 'with_subject' AS metric, filled AS total, CAST(filled AS DOUBLE) / total * 100 AS pct FROM n
UNION ALL
SELECT 'without_subject', total - filled, CAST(total - filled AS DOUBLE) / total * 100 FROM n
UNION ALL SELECT 'total', total, 100.0 FROM n""",
    "domain_totals": ON_STATUS
    + """
SELECT domain, count(category) AS classified, count(*) - count(category) AS unclassified,
       count(*) AS total, count(*) FILTER (WHERE processed) AS processed,
       count(*) FILTER (WHERE NOT processed) AS pending,
       CAST(count(category) AS DOUBLE) / count(*) * 100 AS classified_pct,
       CAST(count(*) - count(category) AS DOUBLE) / count(*) * 100 AS unclassified_pct
FROM status GROUP BY domain""",
    "category_breakdown": ON_STATUS
    + """
SELECT domain, category, total,
       CAST(total AS DOUBLE) / sum(total) OVER (PARTITION BY domain) * 100 AS share_pct
FROM (SELECT domain, category, count(*) AS total FROM status WHERE category IS NOT NULL
      GROUP BY domain, category)""",
    "pending_per_domain": ON_STATUS
    + "SELECT domain, count(*) FILTER (WHERE NOT processed) AS pending FROM status GROUP BY domain",
    "method_audit": ON_STATUS_KW
    + """
SELECT domain, method, count(*) AS total, count(category) AS classified
FROM status GROUP BY domain, method""",
    "domain_share_by_entry_month": ON_STATUS
    + f"""
SELECT domain, {_ENTRY} AS month, count(*) AS total, count(category) AS classified,
       CAST(count(category) AS DOUBLE) / count(*) * 100 AS classified_pct
FROM status JOIN cases USING (case_id) GROUP BY 1, 2""",
    "domain_share_by_register_month": ON_STATUS
    + f"""
SELECT domain, {_REGISTER} AS month, count(*) AS total, count(category) AS classified,
       count(*) FILTER (WHERE NOT {_FILLED}) AS without_subject,
       CAST(count(category) AS DOUBLE) / count(*) * 100 AS classified_pct,
       CAST(count(*) FILTER (WHERE NOT {_FILLED}) AS DOUBLE) / count(*) * 100
         AS without_subject_pct
FROM status JOIN cases USING (case_id) GROUP BY 1, 2""",
    "domain_monthly_export": _EXPORT
    + """
SELECT domain, year_month, substring(year_month, 1, 4) AS year, substring(year_month, 6, 2) AS month,
       classified, total, CAST(classified AS DOUBLE) / total * 100 AS classified_pct
FROM monthly""",
    "domain_monthly_export_text": _EXPORT
    + """
SELECT domain, year_month, substring(year_month, 1, 4) AS year, substring(year_month, 6, 2) AS month,
       format('{:,}', classified) AS classified, format('{:,}', total) AS total,
       format('{:.4f}%', CAST(classified AS DOUBLE) / total * 100) AS classified_pct
FROM monthly""",
    "progress_matrix": ON_STATUS
    + f"""
SELECT domain, processed, category IS NOT NULL AS has_category, count(*) AS total
FROM status JOIN cases USING (case_id) WHERE {_MONTH} GROUP BY 1, 2, 3""",
    "progress_summary": ON_STATUS
    + f"""
SELECT domain, count(*) AS total, count(*) FILTER (WHERE processed) AS processed,
       count(*) FILTER (WHERE processed AND category IS NOT NULL) AS positive,
       count(*) FILTER (WHERE processed AND category IS NULL) AS negative,
       count(*) FILTER (WHERE NOT processed) AS pending
FROM status JOIN cases USING (case_id) WHERE {_MONTH} GROUP BY 1""",
    "metrics_report": ON_STATUS[:-1]
    + f""",
n AS (SELECT count(*) FILTER (WHERE {_FILLED}) AS filled, count(*) AS total FROM cases),
t AS (SELECT domain, count(category) AS classified, count(*) AS total,
             count(*) FILTER (WHERE processed) AS processed FROM status GROUP BY domain),
g AS (SELECT domain, category, count(*) AS total FROM status WHERE category IS NOT NULL
      GROUP BY domain, category)
SELECT 'subject' AS section, CAST(NULL AS VARCHAR) AS domain, 'with_subject' AS label,
       filled AS total, CAST(filled AS DOUBLE) / total * 100 AS pct FROM n
UNION ALL SELECT 'subject', NULL, 'without_subject', total - filled,
       CAST(total - filled AS DOUBLE) / total * 100 FROM n
UNION ALL SELECT 'subject', NULL, 'total', total, 100.0 FROM n
UNION ALL SELECT 'month', NULL, {_ENTRY}, count(*), NULL FROM cases GROUP BY 3
UNION ALL SELECT 'domain', domain, 'classified', classified,
       CAST(classified AS DOUBLE) / total * 100 FROM t
UNION ALL SELECT 'domain', domain, 'unclassified', total - classified,
       CAST(total - classified AS DOUBLE) / total * 100 FROM t
UNION ALL SELECT 'domain', domain, 'total', total, NULL FROM t
UNION ALL SELECT 'domain', domain, 'processed', processed, NULL FROM t
UNION ALL SELECT 'domain', domain, 'pending', total - processed, NULL FROM t
UNION ALL SELECT 'category', domain, category, total,
       CAST(total AS DOUBLE) / sum(total) OVER (PARTITION BY domain) * 100 FROM g""",
    "mark_blank": ON_STATUS
    + f"""
SELECT s.domain, s.case_id, s.category, s.processed OR NOT {_FILLED} AS processed,
       CASE WHEN NOT s.processed AND NOT {_FILLED} THEN 'VACIO' ELSE s.method END AS method
FROM status s JOIN cases c USING (case_id)""",
    "mark_no_keyword": BOTH
    + """
SELECT s.domain, s.case_id, s.category,
       s.processed OR coalesce(NOT v.kw, FALSE) AS processed,
       CASE WHEN NOT s.processed AND coalesce(NOT v.kw, FALSE) THEN 'KEYWORDS' ELSE s.method END
         AS method
FROM status s JOIN verdicts v ON s.case_id = v.case_id AND s.domain = v.domain""",
    "keyword_misses": BOTH
    + """
SELECT case_id, concat_ws('|', CASE WHEN NOT kw_licence THEN 'licence' END,
       CASE WHEN NOT kw_contact THEN 'contact' END,
       CASE WHEN NOT kw_abusive_words THEN 'abusive_words' END) AS missed
FROM hits WHERE subject IS NOT NULL""",
    "choice_criteria": _requests(
        0,
        "Determinar si el asunto de la petición ciudadana PQRS corresponde a ",
        " y seleccionar la subcategoría adecuada, o ''NO_APLICA''.",
    ),
    "closed_choice_criteria": _requests(
        1,
        "Determinar la subcategoría adecuada de ",
        " para la siguiente petición ciudadana.",
    ),
    "build_prompts": _with(CASES, READABLE, CHOICES)
    + f"""
SELECT t.case_id, b.domain,
       'Domain: ' || upper(replace(b.domain, '_', ' ')) || ' (' || replace(b.domain, '_', ' ') || ')'
       || chr(10) || b.bullets || chr(10) || 'Answer with one of these or NO_APLICA.' || chr(10)
       || 'Text: "' || {_strip("t.subject")} || '"' || chr(10) || 'Respuesta:' AS prompt
FROM readable t CROSS JOIN (
  SELECT domain, string_agg('- ' || category, chr(10) ORDER BY ord) AS bullets
  FROM choices GROUP BY domain) b""",
    "engine_windows": ON_CASES
    + f"""
SELECT case_id, length(subject) AS n_chars,
       {_strip("substring(subject, 1, 600)")} AS prompt_text,
       {_strip("substring(subject, 1, 800)")} AS choice_text
FROM cases""",
    "classify_rules": BOTH
    + "SELECT domain, case_id, category, TRUE AS processed, method FROM outcomes",
    "classify_rules_with_keywords": BOTH
    + """
SELECT o.domain, o.case_id, CASE WHEN s.processed THEN o.category ELSE k.category END AS category,
       TRUE AS processed, CASE WHEN s.processed THEN o.method ELSE k.method END AS method
FROM outcomes o JOIN outcomes_kw k ON o.case_id = k.case_id AND o.domain = k.domain
JOIN status s ON o.case_id = s.case_id AND o.domain = s.domain""",
    "rule_scores": BOTH
    + """, counts AS (
  SELECT case_id, 'licence' AS domain, CAST(gnu AS INT) + CAST(mit AS INT) + CAST(apache AS INT)
         + CAST(lic AS INT) AS total,
         greatest(CAST(gnu AS INT), CAST(mit AS INT), CAST(apache AS INT), CAST(lic AS INT)) AS best,
         list_reverse_sort([CAST(gnu AS INT), CAST(mit AS INT), CAST(apache AS INT),
                            CAST(lic AS INT)])[2] AS second FROM hits
  UNION ALL
  SELECT case_id, 'contact', CAST(email AS INT) + CAST(phone AS INT),
         greatest(CAST(email AS INT), CAST(phone AS INT)),
         least(CAST(email AS INT), CAST(phone AS INT)) FROM hits
  UNION ALL
  SELECT case_id, 'abusive_words', insult + contempt, greatest(insult, contempt),
         least(insult, contempt) FROM hits
  UNION ALL
  SELECT case_id, 'language', en + de + es + fr, greatest(en, de, es, fr),
         list_reverse_sort([en, de, es, fr])[2] FROM hits
)
SELECT s.case_id, s.domain, coalesce(v.found, 'NO_APLICA') AS answer,
       CASE WHEN total = 0 THEN 1.0 ELSE CAST(best AS DOUBLE) / CAST(total AS DOUBLE) END
         AS confidence,
       CASE WHEN total = 0 THEN 1.0
            ELSE CAST(best AS DOUBLE) / CAST(total AS DOUBLE)
                 - CAST(second AS DOUBLE) / CAST(total AS DOUBLE) END AS margin
FROM status s JOIN verdicts v ON s.case_id = v.case_id AND s.domain = v.domain
JOIN counts c ON s.case_id = c.case_id AND s.domain = c.domain
WHERE NOT s.processed AND v.subject IS NOT NULL AND trim(v.subject) <> ''""",
    "normalise_generated_answers": _with(CASES, READABLE)
    + f"""
SELECT case_id, domain,
       CASE WHEN contains(upper(body), 'NO_APLICA') OR contains(upper(body), 'NO APLICA')
            THEN 'NO_APLICA' ELSE {_named("body")} END AS answer
FROM (SELECT case_id, domain,
             {_strip("replace(" + _strip("' Respuesta: ' || subject") + ", 'Respuesta:', '')")} AS body
      FROM texts)""",
    "normalise_choice_answers": _with(CASES, READABLE)
    + f"SELECT case_id, domain, {_named('subject')} AS answer FROM texts",
    "apply_outcomes": _with(CASES, HITS, _outcomes(_METHOD), _status(), READABLE)
    + f"""
, answers AS (SELECT case_id, domain, {_named("subject")} AS answer FROM texts)
SELECT s.domain, s.case_id,
       CASE WHEN NOT s.processed THEN nullif(a.answer, 'NO_APLICA') ELSE s.category END AS category,
       s.processed OR a.answer IS NOT NULL AS processed,
       CASE WHEN NOT s.processed AND a.answer IS NOT NULL THEN 'IA' ELSE s.method END AS method
FROM status s LEFT JOIN answers a ON s.case_id = a.case_id AND s.domain = a.domain""",
    "classify_callable": BOTH
    + """
SELECT s.domain, s.case_id,
       CASE WHEN s.processed THEN s.category WHEN failing THEN NULL
            WHEN s.domain = 'abusive_words' AND insult > 0 THEN 'Insult'
            WHEN s.domain = 'abusive_words' AND contempt > 0 THEN 'Contempt'
            WHEN s.domain = 'language' AND en > 0 THEN 'English'
            WHEN s.domain = 'language' AND de > 0 THEN 'German'
            WHEN s.domain = 'language' AND es > 0 THEN 'Spanish'
            WHEN s.domain = 'language' AND fr > 0 THEN 'French'
            WHEN s.domain IN ('licence', 'contact') THEN v.found END AS category,
       s.processed OR NOT failing AS processed,
       CASE WHEN s.processed THEN s.method WHEN failing THEN NULL
            WHEN v.subject IS NULL OR trim(v.subject) = '' THEN 'VACIO' ELSE 'IA' END AS method
FROM status s JOIN verdicts v ON s.case_id = v.case_id AND s.domain = v.domain
JOIN (SELECT *, coalesce(contains(subject, '|') AND trim(subject) <> '', FALSE) AS failing
      FROM hits) h ON s.case_id = h.case_id""",
    "classify_model": ON_STATUS
    + """
, labelled AS (
  SELECT domain, case_id, coalesce(category, 'NO_APLICA') AS label FROM status WHERE method = 'IA'
),
spoken AS MATERIALIZED (
  SELECT case_id, unnest(regexp_extract_all(lower(subject), '[\\p{L}\\p{N}]+')) AS word
  FROM cases WHERE subject IS NOT NULL
),
counted AS MATERIALIZED (
  SELECT domain, label, word, count(*) AS n FROM labelled JOIN spoken USING (case_id)
  GROUP BY domain, label, word
),
vocabulary AS (SELECT DISTINCT word FROM counted),
labels AS (
  SELECT domain, label, ln(n / sum(n) OVER (PARTITION BY domain)) AS prior
  FROM (SELECT domain, label, count(*) AS n FROM labelled GROUP BY domain, label)
),
bases AS (
  SELECT l.domain, l.label, l.prior,
         ln(coalesce(t.total, 0) + (SELECT count(*) FROM vocabulary)) AS base
  FROM labels l LEFT JOIN
    (SELECT domain, label, sum(n) AS total FROM counted GROUP BY domain, label) t
    ON l.domain = t.domain AND l.label = t.label
),
waiting AS (
  SELECT s.domain, s.case_id FROM status s JOIN cases c USING (case_id)
  WHERE NOT s.processed AND c.subject IS NOT NULL AND trim(c.subject) <> ''
),
known AS (
  SELECT case_id, count(*) AS n_known FROM spoken JOIN vocabulary USING (word) GROUP BY case_id
),
gained AS (
  SELECT case_id, domain, label, sum(ln(n + 1)) AS gain
  FROM spoken JOIN counted USING (word) GROUP BY case_id, domain, label
),
answers AS (
  SELECT w.domain, w.case_id, b.label
  FROM waiting w JOIN bases b USING (domain)
  LEFT JOIN known k ON w.case_id = k.case_id
  LEFT JOIN gained g ON w.case_id = g.case_id AND w.domain = g.domain AND b.label = g.label
  QUALIFY row_number() OVER (
    PARTITION BY w.domain, w.case_id
    ORDER BY round(prior + coalesce(gain, 0) - coalesce(n_known, 0) * base, 6) DESC, b.label
  ) = 1
)
SELECT s.domain, s.case_id,
       CASE WHEN s.processed THEN s.category ELSE nullif(a.label, 'NO_APLICA') END AS category,
       s.processed OR a.label IS NOT NULL OR blank AS processed,
       CASE WHEN s.processed THEN s.method WHEN blank THEN 'VACIO'
            WHEN a.label IS NOT NULL THEN 'IA' END AS method
FROM status s
JOIN (SELECT case_id, subject IS NULL OR trim(subject) = '' AS blank FROM cases) c
  ON s.case_id = c.case_id
LEFT JOIN answers a ON s.case_id = a.case_id AND s.domain = a.domain""",
    "reset_month": ON_STATUS
    + f"""
SELECT s.domain, s.case_id, CASE WHEN NOT hit THEN s.category END AS category,
       s.processed AND NOT hit AS processed, CASE WHEN NOT hit THEN s.method END AS method
FROM status s JOIN (SELECT case_id, coalesce({_MONTH}, FALSE) AS hit FROM cases) c
  ON s.case_id = c.case_id""",
    "reset_month_keep_method": ON_STATUS
    + f"""
SELECT s.domain, s.case_id, CASE WHEN NOT (hit AND own) THEN s.category END AS category,
       s.processed AND NOT (hit AND own) AS processed, s.method
FROM (SELECT *, domain IN ('licence', 'contact') AS own FROM status) s
JOIN (SELECT case_id, coalesce({_MONTH}, FALSE) AS hit FROM cases) c ON s.case_id = c.case_id""",
    "purge_months_status": ON_STATUS
    + f"""
SELECT * FROM status WHERE case_id NOT IN (SELECT case_id FROM cases WHERE {_MONTHS})""",
    "purge_months_cases": ON_CASES
    + f"""
SELECT case_id, subject, entry_date, register_date FROM cases
WHERE NOT coalesce({_MONTHS}, FALSE)""",
    "export_month": ON_CASES + f"SELECT * FROM cases WHERE {_MONTH}",
    "sample_strata": _with(CASES, HITS, _outcomes(_METHOD), _SAMPLE)
    + """
SELECT case_id, domain, category AS original_category, method AS original_method, subject
FROM drawn WHERE rn <= quota""",
    "evaluate_rows": ON_EVALUATION
    + """
SELECT case_id, domain, original_category, predicted, match, round(confidence, 4) AS confidence,
       round(margin, 4) AS margin FROM evaluated""",
    "evaluate_sample": _with(CASES, HITS, _outcomes(_METHOD), _SAMPLE)
    + f"""
SELECT domain, category AS original_category, {_AGREEMENT} FROM (
  SELECT domain, category, category = CASE
           WHEN domain = 'licence' AND contains(t, 'gnu general public license') THEN 'GNU General Public License'
           WHEN domain = 'licence' AND contains(t, 'mit license') THEN 'MIT License'
           WHEN domain = 'licence' AND contains(t, 'apache license') THEN 'Apache License'
           WHEN domain = 'licence' AND contains(t, 'license') THEN 'License'
           WHEN domain = 'licence' THEN 'GNU General Public License'
           WHEN domain = 'contact' AND contains(t, '@mail3') THEN 'Email'
           WHEN domain = 'contact' AND contains(t, '+') THEN 'Phone'
           WHEN domain = 'contact' THEN 'Email'
           WHEN domain = 'abusive_words' AND contains(t, 'idiot') THEN 'Insult'
           WHEN domain = 'abusive_words' AND contains(t, 'trash') THEN 'Contempt'
           WHEN domain = 'abusive_words' THEN 'Insult'
           WHEN contains(t, ' the ') THEN 'English'
           WHEN contains(t, ' der ') THEN 'German'
           WHEN contains(t, ' los ') THEN 'Spanish'
           WHEN contains(t, ' les ') THEN 'French'
           ELSE 'English' END AS match
  FROM (SELECT *, lower(subject) AS t FROM drawn WHERE rn <= quota))
GROUP BY domain, category""",
    "agreement_global": ON_EVALUATION
    + f"""
SELECT {_AGREEMENT}, round(avg(round(confidence, 4)), 4) AS mean_confidence FROM evaluated""",
    "agreement_by_domain": ON_EVALUATION
    + f"""
SELECT domain, {_AGREEMENT}, round(avg(confidence), 4) AS mean_confidence
FROM evaluated GROUP BY domain""",
    "agreement_by_category": ON_EVALUATION
    + f"SELECT domain, original_category, {_AGREEMENT} FROM evaluated GROUP BY 1, 2",
    "confusion_matrix": ON_EVALUATION
    + """
SELECT domain, original_category, predicted, count(*) AS total FROM evaluated GROUP BY 1, 2, 3""",
    "confusion_wide": ON_EVALUATION
    + """
SELECT original_category, count(*) FILTER (WHERE predicted = 'English') AS "English",
       count(*) FILTER (WHERE predicted = 'German') AS "German",
       count(*) FILTER (WHERE predicted = 'Spanish') AS "Spanish",
       count(*) FILTER (WHERE predicted = 'French') AS "French",
       count(*) FILTER (WHERE predicted = 'NO_APLICA') AS "NO_APLICA",
       count(*) FILTER (WHERE predicted LIKE 'ERROR%') AS "ERROR",
       count(*) FILTER (WHERE predicted NOT IN ('English', 'German', 'Spanish', 'French',
                        'NO_APLICA') AND predicted NOT LIKE 'ERROR%') AS "OTHER",
       count(*) AS total
FROM evaluated WHERE domain = 'language' GROUP BY 1""",
    "predicted_distribution": ON_EVALUATION
    + """
SELECT domain, original_category,
       string_agg(predicted || '=' || n, ', ' ORDER BY predicted) AS predicted
FROM (SELECT domain, original_category, predicted, count(*) AS n FROM evaluated GROUP BY 1, 2, 3)
GROUP BY 1, 2""",
    "top_disagreements": ON_EVALUATION
    + """
SELECT case_id, domain, original_category, predicted, round(confidence, 4) AS confidence, top3
FROM evaluated WHERE NOT match ORDER BY case_id, domain LIMIT 8""",
}


# --- the stored path ----------------------------------------------------------------------------

_PURGED = f"coalesce({_MONTHS}, FALSE)"
_RESET = f"coalesce({_MONTH}, FALSE)"

STORE_ORACLES: dict[str, str] = {
    "whole_run": _with(CASES, HITS, _outcomes(_METHOD))
    + f"""
SELECT o.domain, o.case_id,
       CASE WHEN done THEN o.category END AS category, done AS processed,
       CASE WHEN done THEN o.method END AS method
FROM (SELECT o.*, o.domain = 'contact' AND c.order_status <> 'O'
                  AND NOT {_RESET} AND NOT {_PURGED} AS done
      FROM outcomes o JOIN cases c USING (case_id)) o""",
    "reseed_after_partial_purge": _with(CASES, HITS, _outcomes(_METHOD))
    + f"""
SELECT o.domain, o.case_id,
       CASE WHEN done THEN o.category END AS category, done AS processed,
       CASE WHEN done THEN o.method END AS method
FROM (SELECT o.*, c.order_status <> 'O'
                  AND NOT (o.domain IN ('licence', 'contact') AND {_PURGED}) AS done
      FROM outcomes o JOIN cases c USING (case_id)) o""",
    "load_counts": """
WITH loads AS (
  SELECT 1 AS load, CAST(o_orderkey AS VARCHAR) AS case_id FROM orders WHERE o_orderstatus = 'F'
  UNION ALL
  SELECT 2, CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderstatus <> 'O'
  UNION ALL
  SELECT 3, CAST(l_orderkey AS VARCHAR) FROM lineitem
),
firsts AS (SELECT case_id, min(load) AS load FROM loads WHERE case_id IS NOT NULL GROUP BY case_id)
SELECT CAST(l.load AS INTEGER) AS load, l.n AS processed, coalesce(f.n, 0) AS inserted,
       l.n - coalesce(f.n, 0) - l.rejected AS existing, l.rejected
FROM (SELECT load, count(*) AS n, count(*) - count(case_id) AS rejected FROM loads GROUP BY load) l
LEFT JOIN (SELECT load, count(*) AS n FROM firsts GROUP BY load) f USING (load)""",
    "streamed_intake": ON_CASES
    + """
SELECT case_id,
       CASE WHEN order_status = 'O' THEN concat_ws(' ', 'later', priority)
            ELSE nullif(replace(replace(subject, chr(13) || chr(10), chr(10)), chr(13), chr(10)), '')
       END AS subject,
       entry_date
FROM cases""",
    "snapshot_difference": ON_CASES
    + f"""
SELECT domain, case_id, change FROM (
  SELECT domain, case_id,
         CASE WHEN order_status = 'O' THEN 'added'
              WHEN {_PURGED} THEN 'removed'
              WHEN {_RESET} AND domain = 'contact' THEN 'changed' END AS change
  FROM cases CROSS JOIN domains
) WHERE change IS NOT NULL""",
    "delimited_round_trip": """
SELECT CAST(doc_id AS VARCHAR) AS case_id,
       nullif(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)), '') AS subject,
       nullif(lang, '') AS entry_date, nullif(source, '') AS register_date,
       FALSE AS was_ragged,
       CASE WHEN doc_id IS NULL THEN 'missing_key' END AS reject_reason
FROM documents
UNION ALL
SELECT CASE WHEN s_suppkey % 3 < 2 THEN 's' || s_suppkey END,
       CASE WHEN s_suppkey % 3 = 1 THEN 'nul ' || chr(0) || ' ' || s_name ELSE s_name END,
       CASE WHEN s_suppkey % 3 > 0 THEN 'x' END, CASE WHEN s_suppkey % 3 > 0 THEN 'y' END,
       s_suppkey % 3 <> 1,
       CASE s_suppkey % 3 WHEN 1 THEN 'nul_character' WHEN 2 THEN 'missing_key' END
FROM supplier""",
    "changed_tables": "SELECT 'orders' AS source, CAST(count(*) AS BIGINT) AS n_rows FROM orders",
    "evaluation_files": ON_EVALUATION
    + """
SELECT case_id, domain, original_category, predicted, match,
       CAST(count(*) AS BIGINT) AS in_json, CAST(count(*) AS BIGINT) AS in_csv
FROM evaluated GROUP BY case_id, domain, original_category, predicted, match""",
    "evaluation_counts": ON_EVALUATION
    + """
SELECT count(*) AS total, CAST(sum(CAST(match AS INT)) AS BIGINT) AS matches,
       CAST(0 AS BIGINT) AS failures FROM evaluated""",
    "registered_domains": """
WITH topics AS (
  SELECT source, coalesce(lang, 'none') AS name, 0 AS round FROM documents WHERE source IS NOT NULL
  UNION
  SELECT source, coalesce(lang, 'none'), 1 FROM documents JOIN labels USING (doc_id)
  WHERE source IS NOT NULL
)
SELECT source AS domain, string_agg(name, '|' ORDER BY name) AS categories,
       string_agg(name, '|' ORDER BY name) AS keywords
FROM topics t
WHERE round = (SELECT max(round) FROM topics u WHERE u.source = t.source)
GROUP BY source""",
}
