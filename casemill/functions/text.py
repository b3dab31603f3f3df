"""Text predicates and projections.

``is_blank`` trims spaces only, so a tab-only text is *not* blank; ``strip_all`` removes every
white-space character. Both are native expressions and stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence
from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that Unicode counts as white space, plus the four separators U+001C..U+001F.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def is_blank(text: Column) -> Column:
    """missing, empty or spaces only. Never NULL."""
    return text.isNull() | (F.trim(text) == "")


def has_text(text: Column) -> Column:
    """the negation of :func:`is_blank`. Never NULL."""
    return text.isNotNull() & (F.trim(text) != "")


def strip_all(text: Column) -> Column:
    """Remove leading and trailing white space of every kind."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def clip(text: Column, max_chars: int | None) -> Column:
    """Keep the first ``max_chars`` characters (all of them when None), then strip."""
    return strip_all(text if max_chars is None else F.substring(text, 1, max_chars))


def any_keyword(lowered: Column, keywords: Sequence[str]) -> Column:
    """any keyword occurs in an already lower-cased text.

    ``%`` and ``_`` inside a keyword are wildcards and accents count. Catalyst rewrites a
    pattern without inner wildcards to ``contains``. NULL text gives NULL, as ILIKE does.
    """
    if not keywords:
        return F.lit(False)
    hits = [lowered.like(f"%{k.lower()}%") for k in keywords]
    result = hits[0]
    for hit in hits[1:]:
        result = result | hit
    return result


def first_contained(lowered: Column, labels: Sequence[str]) -> Column:
    """The first label (list order) whose lower-cased form occurs in the text, else NULL."""
    picked = F.lit(None).cast("string")
    for label in reversed(labels):
        picked = F.when(lowered.contains(label.lower()), F.lit(label)).otherwise(picked)
    return picked


def display_name(domain: str) -> str:
    """X11: the domain name as people read it."""
    return domain.replace("_", " ")


def bullet_list(items: Sequence[str]) -> str:
    """One item per line, each behind ``- ``."""
    return "\n".join(f"- {item}" for item in items)


def fill_template(template: str, values: dict[str, str], text_field: str, text: Column) -> Column:
    """Fill a ``{field}`` template whose one varying field is a column.

    The fixed fields are resolved while the plan is built; the text is concatenated last, so
    braces inside it are never expanded.
    """
    pieces: list[Column] = []
    literal = ""
    for before, field, _, _ in Formatter().parse(template):
        literal += before
        if field is None:
            continue
        if field == text_field:
            pieces += [F.lit(literal), text]
            literal = ""
        else:
            literal += values[field]
    pieces.append(F.lit(literal))
    return F.concat(*pieces)
