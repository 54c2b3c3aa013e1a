"""Conversions from raw text. Every cast is a ``try_`` form: ANSI mode raises otherwise."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ontime import schema

# Accepted spellings of numbers. Digits are never given back: what follows them is no digit.
INTEGER_PATTERN = r"^[+-]?+\d++(?:\.0++)?+$"
FLOAT_PATTERN = r"^[+-]?+(?:\d++(?:\.\d*+)?+|\.\d++)(?:[eE][+-]?+\d++)?+$"
DATE_FORMAT = "yyyy-MM-dd"
PLAIN_DATE_PATTERN = r"^[1-9]\d{3}-\d\d-\d\d$"  # read alike by a cast and by the format, at a tenth of the cost


def clean_text(value: Column) -> Column:
    """Trim spaces; an empty result is a missing value."""
    return F.nullif(F.trim(value), F.lit(""))


def to_integer(text: Column) -> Column:
    """``12`` and ``12.0`` are integers, ``12.5`` is not."""
    return F.when(text.rlike(INTEGER_PATTERN), text.try_cast("double").try_cast("int"))


def to_float(text: Column) -> Column:
    """Finite decimal numbers only: NaN, infinities and Java suffixes are refused.

    Spark orders NaN above every number, so an accepted ``NaN`` delay would count as delayed.
    """
    return F.when(text.rlike(FLOAT_PATTERN), text.try_cast("double"))


def to_date(text: Column) -> Column:
    plain = text.rlike(PLAIN_DATE_PATTERN) & (F.length(text) == 10)
    return F.when(plain, text.try_cast("date")).when(text != "", F.try_to_date(text, DATE_FORMAT))


def to_text(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


_BY_ROLE = {"integer": to_integer, "float": to_float, "date": to_date, "text": to_text}


def convert(name: str, text: Column) -> Column:
    """Convert trimmed text according to the declared role of the column."""
    if name not in schema.COLUMN_ROLES:
        raise ValueError(f"no conversion declared for column {name!r}")
    return _BY_ROLE[schema.COLUMN_ROLES[name]](text)


def category(value: Column) -> Column:
    """Text form of a category, with an explicit level for a missing one."""
    return F.coalesce(value.cast("string"), F.lit(schema.MISSING_CATEGORY))


def joined_key(*parts: Column) -> Column:
    """Composite category ``a-b-c``; missing as soon as one part is missing."""
    pieces = [parts[0]]
    for part in parts[1:]:
        pieces += [F.lit("-"), part]
    return F.concat(*pieces)


def code(value: Column) -> Column:
    """Normalised carrier or airport code."""
    return F.upper(F.trim(value))
