"""Release-lag rules: when a value was published if the source does not say.

Every date produced here is an estimate and must be stored with
``publication_date_estimated = true``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import as_col


def _days_after_month_end(days: int) -> Callable[[Column | str], Column]:
    return lambda day: F.date_add(F.last_day(as_col(day)), days)


def _fixed_day(years_later: int, month: int, day: int) -> Callable[[Column | str], Column]:
    return lambda year: F.make_date(
        as_col(year).cast("int") + F.lit(years_later), F.lit(month), F.lit(day)
    )


# Assessments whose results came out in the following year.
NAEP_LATE_YEARS = (2009, 2017, 2024)


def naep(year: Column | str) -> Column:
    y = as_col(year).cast("int")
    return F.when(
        y.isin(*NAEP_LATE_YEARS), F.make_date(y + 1, F.lit(6), F.lit(30))
    ).otherwise(F.make_date(y, F.lit(12), F.lit(31)))


def month_end(day: Column | str) -> Column:
    return F.last_day(as_col(day))


def finance_report(coverage_end: Column | str) -> Column:
    return F.date_add(as_col(coverage_end), 20)


# The documented release lags.
RULES: dict[str, Callable[[Column | str], Column]] = {
    "month_end": month_end,
    "bls_laus_state": _days_after_month_end(21),
    "bls_cpi": _days_after_month_end(15),
    "bls_employment_situation": _days_after_month_end(8),
    "bls_qcew_annual": _fixed_day(1, 6, 30),
    "acs_1year": _fixed_day(1, 9, 30),
    "acs_5year": _fixed_day(1, 12, 31),
    "pep_vintage": _fixed_day(0, 12, 31),
    "census_geography": _fixed_day(0, 12, 31),
    "urban_rural": _fixed_day(2, 12, 31),
    "bea_annual": _fixed_day(1, 9, 30),
    "bea_rpp": _fixed_day(1, 12, 31),
    "naep": naep,
    "fec_summary": finance_report,
}


def apply_rule(rule: str, value: Column | str) -> Column:
    """The estimated publication day; NULL in, NULL out."""
    return RULES[rule](value)


def from_url_month_folder(url: Column | str) -> Column:
    """End of the month named by a ``/YYYY-MM/`` folder of a download address."""
    month = F.nullif(F.regexp_extract(as_col(url), r"/(\d{4}-\d{2})/", 1), F.lit(""))
    return F.last_day(F.concat(month, F.lit("-01")).try_cast("date"))
