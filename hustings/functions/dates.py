"""Date expressions: election calendar, statistical periods, text formats."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..errors import PointInTimeError
from .scalars import as_col


def cutoff(value: dt.date | dt.datetime | str) -> dt.date:
    """The calendar day of an as-of argument."""
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    try:
        return dt.datetime.fromisoformat(str(value).strip()).date()
    except ValueError as exc:
        raise PointInTimeError(f"not a date: {value!r}") from exc


def election_day(year: int) -> dt.date:
    """The Tuesday after the first Monday of November (driver side)."""
    return next(
        day
        for day in (dt.date(year, 11, n) for n in range(2, 9))
        if day.weekday() == 1
    )


def general_election_date(year: Column | str) -> Column:
    """The Tuesday after the first Monday of November, as an expression."""
    october_end = F.make_date(as_col(year).cast("int"), F.lit(10), F.lit(31))
    return F.date_add(F.next_day(october_end, "MON"), 1)


def month_floor(day: Column | str) -> Column:
    return F.trunc(as_col(day), "month")


def month_start(year: Column | str, month: Column | str) -> Column:
    return F.make_date(as_col(year).cast("int"), as_col(month).cast("int"), F.lit(1))


def month_number(day: Column | str) -> Column:
    """Months since year 0: makes 'k months earlier' a plain integer offset."""
    return F.year(as_col(day)) * 12 + F.month(as_col(day))


def bls_period_to_date(year: Column | str, period: Column | str) -> Column:
    """Start day of M01..M12, Q01..Q04 and A01; yearly averages give NULL."""
    kind = F.substring(as_col(period), 1, 1)
    number = F.substring(as_col(period), 2, 2).try_cast("int")
    month = (
        F.when((kind == "M") & number.between(1, 12), number)
        .when((kind == "Q") & number.between(1, 4), 3 * (number - 1) + 1)
        .when(kind == "A", F.lit(1))
    )
    return F.when(
        month.isNotNull(), F.make_date(as_col(year).try_cast("int"), month, F.lit(1))
    )


COMMON_FORMATS = ("M/d/yyyy", "yyyyMMdd", "MMMM d, yyyy", "MMM d, yyyy")


def parse_date(value: Column | str, formats: Sequence[str] = ()) -> Column:
    """First format that reads the text; ISO and a few common ones come last."""
    text = F.trim(as_col(value).cast("string"))
    tries = [F.try_to_timestamp(text, F.lit(fmt)).cast("date") for fmt in formats]
    tries.append(text.try_cast("date"))
    tries += [F.try_to_timestamp(text, F.lit(fmt)).cast("date") for fmt in COMMON_FORMATS]
    return F.coalesce(*tries)
