"""Exact money, plain numbers and guarded arithmetic from text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as fv
from .text import WHITE_SPACE, clean_text

MONEY = "decimal(18,2)"
PERCENT = "decimal(9,4)"
# Sums are brought to this type before they are divided: decimal division gives up scale on very wide
# operands, and (24,2) still leaves 14 decimals in the quotient with room for 10**22 in the sum.
SUM = "decimal(24,2)"

# Up to two significant decimals.
_PLAIN_MONEY = r"^([+-]?(?:\p{Nd}+(?:\.\p{Nd}{0,2})?|\.\p{Nd}{1,2}))0*$"
# Sign, whole digits, decimals, sign and digits of the exponent.
_ANY_MONEY = r"^([+-]?)(\p{Nd}*)\.?(\p{Nd}*)(?:[eE]([+-]?)0*(?=\p{Nd}|(?<=0))(\p{Nd}*))?$"
# Digits that amounts of MONEY can have at most, with some room for leading zeros; more zeros are never written out.
_MOST_ZEROS = 40
# Dots before the last comma, then dots behind a comma.
_DOT_BEFORE_COMMA = r"\.(?=[^,]*,)"
_DOT_BEHIND_COMMA = r"(,[^.]*|\G(?!\A)[^.]*)\."
_NUMBER = r"(?i)^[+-]?(([0-9]+(\.[0-9]*)?|\.[0-9]+)(e[+-]?[0-9]+)?|inf|infinity)$"


def _bare_number(c: Column) -> Column:
    """Text without currency sign and white space, with `.` as the only decimal mark.

    Next to a comma dots are grouping and the comma is the decimal mark; without one they stay.
    """
    dense = F.translate(F.replace(c, F.lit(fv.CURRENCY_SIGN), F.lit("")), WHITE_SPACE, "")
    grouped = F.regexp_replace(F.regexp_replace(dense, _DOT_BEFORE_COMMA, ""), _DOT_BEHIND_COMMA, "$1")
    return F.translate(grouped, ",", ".")


def number_text(c: Column) -> Column:
    """The normalised text of a number; NULL for null words."""
    return _bare_number(clean_text(c))


def _bare_money(c: Column) -> Column:
    """What `_bare_number` gives, without underscores. Whether there is a comma is asked first, which spares the regexes on dots."""
    digits = F.replace(c, F.lit(fv.CURRENCY_SIGN), F.lit(""))
    grouped = F.translate(digits, ",._" + WHITE_SPACE, ".")
    return F.when(F.contains(c, F.lit(",")), grouped).otherwise(F.translate(digits, "_" + WHITE_SPACE, ""))


def parse_money(c: Column) -> Column:
    """Exact amount; a third significant decimal means NULL, never rounding. Null words match no form.

    Nearly every row is settled by the first branch; the second reads exponents of any size by moving the decimal
    mark in the text, so that no digit is lost. Digits of other scripts and group underscores count as in the plain form.
    """
    text = _bare_money(c)
    plain = F.regexp_extract(text, _PLAIN_MONEY, 1).try_cast(MONEY)
    return F.coalesce(plain, _shifted_money(text))


def _shifted_money(text: Column) -> Column:
    """Cents as digits with the zeros that the exponent adds; NULL if digits below a cent remain."""
    sign, whole, decimals, turn, power = (F.regexp_extract(text, _ANY_MONEY, k) for k in range(1, 6))
    mantissa = F.concat(whole, decimals)
    digits = F.rtrim(mantissa, F.lit("0"))
    exponent = F.when(power == "", F.lit(0)).otherwise(F.concat(turn, power).try_cast("int"))
    zeros = F.length(whole) + exponent.cast("bigint") + 2 - F.length(digits)
    cents = F.concat(sign, digits, F.repeat(F.lit("0"), zeros.cast("int")), F.lit("e-2"))
    zero = F.lit(0).cast(MONEY)
    return F.when(mantissa == "", None).when(digits == "", zero).when(zeros.between(0, _MOST_ZEROS), cents.try_cast(MONEY))


def parse_number(c: Column) -> Column:
    """Double; the guard refuses Java's own suffixes such as `1d` and `5f`. Null words match no form."""
    return F.regexp_extract(_bare_number(c), _NUMBER, 0).try_cast("double")


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """NULL on a zero denominator."""
    return numerator / F.nullif(denominator, F.lit(0))


def weighted_percent(numerator_sum: Column, denominator_sum: Column) -> Column:
    return (safe_ratio(numerator_sum.cast(SUM), denominator_sum.cast(SUM)) * 100).cast(PERCENT)


def mean_amount(total: Column, count: Column, to: str = MONEY) -> Column:
    """Decimal mean rounded half-up once, at the target scale."""
    return (total.cast(SUM) / count).cast(to)


def finite(c: Column) -> Column:
    """Double with NaN and infinities made NULL and negative zero made zero."""
    x = c.try_cast("double")
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), None).when(x == 0, F.lit(0.0)).otherwise(x)
