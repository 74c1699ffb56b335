"""Scalar helpers with the exact NULL, date and number behaviour the registries need."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a number, and as a whole number, in result text.
NUMERIC_TEXT = r"^ *[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)? *\z"
INTEGER_TEXT = r"^ *[+-]?[0-9]+ *\z"
STRIPPED_SYMBOLS = ">=,"
UNKNOWN = "Unknown"


def strip_symbols(text: Column) -> Column:
    """Remove comparison signs and thousands separators from result text."""
    return F.translate(text, STRIPPED_SYMBOLS, "")


def is_numeric(text: Column) -> Column:
    return text.rlike(NUMERIC_TEXT)


def to_double(text: Column) -> Column:
    """The number in the text, NULL where there is none or it is too large (never an error)."""
    number = text.try_cast("double")
    return F.when(is_numeric(text) & (F.abs(number) < F.lit(float("inf"))), number)


def to_int(text: Column) -> Column:
    """The whole number in the text; ``1.5`` or an overflow gives NULL."""
    return F.when(text.rlike(INTEGER_TEXT), F.trim(text).try_cast("int"))


def year_difference(start: Column, end: Column) -> Column:
    """Number of New Years between two dates (not completed years)."""
    return F.year(end) - F.year(start)


def day_difference(start: Column, end: Column) -> Column:
    return F.datediff(end.cast("date"), start.cast("date"))


def earlier_of(candidate: Column, fallback: Column) -> Column:
    """``candidate`` when it is known to be earlier, else ``fallback``.

    Not ``least``: with a NULL fallback the answer is NULL even if the candidate is set.
    """
    return F.when(candidate < fallback, candidate).otherwise(fallback)


def zero_if_null(flag: Column) -> Column:
    return F.coalesce(flag, F.lit(0))


def unknown_if_null(text: Column) -> Column:
    return F.coalesce(text, F.lit(UNKNOWN))


def as_of_date(as_of: str | dt.date | Column | None = None) -> Column:
    """The reference day of a report: today unless a day is given."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of.cast("date")
    return F.lit(str(as_of)).cast("date")
