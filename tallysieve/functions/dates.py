"""Dates from text, and month buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import SPACE_CLASS

# Y-m-d, Y/m/d and d/m/Y, and how their parts read as year-month-day.
DATE_SHAPES = r"([0-9]{4})([-/])([0-9]{1,2})\2([0-9]{1,2})|([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})"
DATE_ORDER = "$1$7-$3$6-$4$5"
_DATE_TEXT = rf"(?s)^(?:{SPACE_CLASS}*(?:{DATE_SHAPES}){SPACE_CLASS}*|.*)$"


def parse_date(c: Column) -> Column:
    """A real calendar day in one of the accepted shapes, otherwise NULL.

    One regex brings every accepted shape to year-month-day and anything else - null words, a year only,
    trailing time - to `--`, which is no date.
    """
    return F.regexp_replace(c, _DATE_TEXT, DATE_ORDER).try_cast("date")


def month_of(c: Column) -> Column:
    """First day of the month, as a date."""
    return F.trunc(c, "month")


def month_stamp(c: Column) -> Column:
    """First instant of the month as a zone-free timestamp, the published form of a month."""
    return month_of(c).cast("timestamp_ntz")
