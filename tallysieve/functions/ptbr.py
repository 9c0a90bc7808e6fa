"""Numbers as Brazilian Portuguese text. Inputs are never changed, only rendered."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as fv
from .numbers import finite

_SWAP_MARKS = (",.", ".,")


def _or_missing(text: Column) -> Column:
    return F.coalesce(text, F.lit(fv.MISSING_TEXT))


def _render(x: Column, places: int) -> Column:
    """`.` between thousands, `,` before decimals; ties go to the even digit."""
    return F.translate(F.format_number(x, places), *_SWAP_MARKS)


def _trimmed(text: Column) -> Column:
    return F.regexp_replace(text, r"(,[0-9]*?)0+$", "$1")


def decimal_text(c: Column, places: int, trim: bool = False) -> Column:
    text = _render(finite(c), places)
    if trim and places:
        text = F.regexp_replace(_trimmed(text), ",$", "")
    return _or_missing(text)


def _compact(x: Column, places: int) -> Column:
    """Compact quantity of a finite number, NULL for NULL."""
    whole = x == F.floor(x)
    fraction = F.regexp_replace(_trimmed(_render(x, places)), ",$", "")
    out = F.when(whole, _render(x, 0)).otherwise(fraction)
    for size, unit in reversed(fv.COMPACT_UNITS):
        out = F.when(F.abs(x) >= size, F.concat(_render(x / float(size), places), F.lit(f" {unit}"))).otherwise(out)
    return out


def compact_number(c: Column, places: int = 1) -> Column:
    return _or_missing(_compact(finite(c), places))


def currency(c: Column) -> Column:
    return _or_missing(F.concat(F.lit("R$ "), _render(finite(c), 2)))


def compact_currency(c: Column, places: int = 1) -> Column:
    """Compact from one thousand up; smaller amounts are shown in full."""
    x = finite(c)
    text = F.when(F.abs(x) < 1000, _render(x, 2)).otherwise(_compact(x, places))
    return _or_missing(F.concat(F.lit("R$ "), text))


def integer_text(c: Column) -> Column:
    """Whole part only, cut towards zero."""
    x = finite(c)
    return _or_missing(_render(x - x % 1, 0))


def percent_text(c: Column, places: int = 2) -> Column:
    """Text of a value that is already a percentage."""
    return _or_missing(F.concat(_render(finite(c), places), F.lit("%")))


def ratio_text(numerator: Column, denominator: Column) -> Column:
    """Ratio as percent text; a missing or zero denominator gives zero percent."""
    share = F.try_divide(finite(numerator), finite(denominator)) * 100
    return F.coalesce(F.concat(_render(finite(share), 2), F.lit("%")), F.lit(fv.ZERO_PERCENT))
