"""Text cleaning and labels as Column expressions; everything stays in the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as fv

# Unicode white space, plus the four ASCII separators that count as white space when text is stripped.
WHITE_SPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
# The same characters as regex classes. Spelled out, they match by table look-up; the `(?U)` classes do not.
SPACE_CLASS = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
INK_CLASS = SPACE_CLASS.replace("[", "[^", 1)


def _clean_pattern() -> str:
    """The whole of a stripped text; no match at all for null words and nothing."""
    words = "|".join(re.escape(w) for w in fv.NULL_WORDS if w)
    return rf"(?s)\A(?!(?i:{words})?\z).+"


def strip(c: Column) -> Column:
    """Drop leading and trailing Unicode white space; plain trim only knows the ASCII blank."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def clean_text(c: Column) -> Column:
    """Stripped text, NULL when only a null word is left; letter case is kept.

    The input is read once. The optimizer copies expressions when it pushes filters down, and a cleaner
    that mentions its input twice doubles at every level of nesting.
    """
    return F.get(F.regexp_extract_all(strip(c), F.lit(_clean_pattern()), F.lit(0)), F.lit(0))


def clean_id(c: Column) -> Column:
    return F.upper(clean_text(c))


def upper_label(c: Column) -> Column:
    return F.upper(strip(c))


def title_label(c: Column) -> Column:
    """Every run of letters starts upper-case, so that `e-commerce` becomes `E-Commerce`."""
    runs = F.regexp_extract_all(F.lower(strip(c)), F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def sentence_label(c: Column) -> Column:
    """First character upper-case, the rest lower-case."""
    text = strip(c)
    return F.concat(F.upper(F.substring(text, 1, 1)), F.lower(F.substring(text, 2, 2147483647)))


def or_not_informed(c: Column) -> Column:
    return F.coalesce(c, F.lit(fv.NOT_INFORMED))


def has_alert(issues: Column) -> Column:
    """True when the issue text holds anything but white space; NULL counts as no alert."""
    return strip(F.coalesce(issues, F.lit(""))) != ""


def alerts_or_none(issues: Column) -> Column:
    return F.when(has_alert(issues), issues).otherwise(F.lit(fv.NO_ALERTS))


def _lookup(c: Column, table: dict[str, str]) -> Column:
    """Constant-map lookup, NULL when the key is unknown."""
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), c)


def rule_label(rule: Column) -> Column:
    """Display label of a rule; an unknown rule id is spelled out from its own words."""
    known = strip(rule)
    return F.coalesce(_lookup(known, fv.RULE_LABELS), title_label(F.replace(known, F.lit("_"), F.lit(" "))))


def severity_label(c: Column) -> Column:
    return F.coalesce(_lookup(c, fv.SEVERITY_LABELS), c)


def status_label(c: Column) -> Column:
    return F.coalesce(_lookup(c, fv.STATUS_LABELS), c)


def contains_text(c: Column, query: str) -> Column:
    """Case-insensitive literal substring; NULL text never matches."""
    return F.coalesce(F.contains(F.lower(c.cast("string")), F.lower(F.lit(query))), F.lit(False))
