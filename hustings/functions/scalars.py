"""Null-safe scalar building blocks (ANSI mode is on in Spark 4, so every cast
and division that may fail goes through its ``try_`` form)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def to_double(value: Column | str) -> Column:
    """Number or NULL; NaN counts as missing."""
    number = as_col(value).try_cast("double")
    return F.when(~F.isnan(number), number)


def to_long(value: Column | str) -> Column:
    """Whole number or NULL, rounding halves to even."""
    return F.bround(to_double(value)).try_cast("bigint")


TRUE_TOKENS = ("true", "1", "t", "yes", "y")


def to_bool(value: Column | str) -> Column:
    text = as_col(value).cast("string")
    return F.when(text.isNotNull(), F.lower(F.trim(text)).isin(*TRUE_TOKENS))


def to_date(value: Column | str) -> Column:
    return as_col(value).try_cast("date")


def to_timestamp(value: Column | str) -> Column:
    return as_col(value).try_cast("timestamp")


def flag(value: Column | str) -> Column:
    """Source-file flag: TRUE/1/T/YES, anything else (also NULL) is false."""
    text = F.upper(F.trim(as_col(value)))
    return F.coalesce(text.isin("TRUE", "1", "T", "YES"), F.lit(False))


def blank_to_null(value: Column | str) -> Column:
    return F.nullif(as_col(value), F.lit(""))


def negative_to_null(value: Column | str) -> Column:
    number = to_double(value)
    return F.when(number >= 0, number)


def below_to_null(value: Column | str, floor: float) -> Column:
    number = to_double(value)
    return F.when(number >= F.lit(float(floor)), number)


def dash_to_null(value: Column | str) -> Column:
    text = F.trim(as_col(value))
    return to_double(F.nullif(text, F.lit("-")))


def share(value: Column | str) -> Column:
    """A share on 0-1, given either as 0-1 or as a percentage."""
    number = to_double(value)
    return F.when(number <= 1, number).otherwise(number / F.lit(100.0))


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Division that yields NULL for a zero or missing denominator."""
    return F.try_divide(
        as_col(numerator).cast("double"), as_col(denominator).cast("double")
    )


def growth(now: Column | str, before: Column | str) -> Column:
    return ratio(now, before) - F.lit(1.0)


def clean_token(value: Column | str) -> Column:
    """Upper case, surrounding blanks cut, inner runs of blanks made single."""
    return F.upper(F.trim(F.regexp_replace(as_col(value), r"\s+", " ")))


def district_label(value: Column | str) -> Column:
    """``statewide``, ``at-large`` for district 0, else a two-digit number."""
    text = F.lower(F.trim(as_col(value)))
    number = text.try_cast("double").try_cast("int")
    return (
        F.when(text.isNull() | text.isin("", "statewide", "nan", "none"), F.lit("statewide"))
        .when(number.isNull(), text)
        .when(number == 0, F.lit("at-large"))
        .when(number < 10, F.lpad(number.cast("string"), 2, "0"))
        .otherwise(number.cast("string"))
    )
