"""Labour market, industry mix, state accounts and national series as of a date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.dates import month_number
from ..functions.scalars import growth, ratio, to_double
from .pit import AsOf, filter_as_of, latest_as_of, snapshot_as_of
from .relational import newest, top_per_key

_REVISION_ORDER = ("publication_date", "retrieval_date", "revision_vintage")


def _newest_revision(
    df: DataFrame, as_of: AsOf | None, keys: list[str], values: list[str]
) -> DataFrame:
    """The newest revision per key in the retrieval that was held on ``as_of``."""
    order = [c for c in _REVISION_ORDER if c in df.columns]
    narrow = df.select(*keys, *values, *order)
    if "retrieval_date" in order:
        return snapshot_as_of(narrow, as_of, keys)
    return top_per_key(narrow, keys, newest(*order))


def _months_back(value: str, series: W, k: int) -> Column:
    """The value exactly ``k`` calendar months earlier, NULL if that month is
    missing: the window is ordered by month number."""
    return F.max(value).over(series.rangeBetween(-k, -k))


def unemployment_features(
    labor: DataFrame, as_of: AsOf, *, seasonally_adjusted: bool = True
) -> DataFrame:
    """Per state the newest public month: level, means of the last 3 and 12
    months, and changes against the month 3 and 12 calendar months earlier."""
    rows = labor
    if "seasonally_adjusted" in rows.columns:
        rows = rows.where(F.col("seasonally_adjusted") == seasonally_adjusted)
    values = ["unemployment_rate", "employment", "labor_force"]
    monthly = _newest_revision(filter_as_of(rows, as_of), as_of, ["state", "date"], values).withColumns(
        {"m": month_number("date"), **{c: to_double(c) for c in values}}
    )
    # One row per state and month by now: a state's window is its months.
    months = W.partitionBy("state").orderBy("m")
    everything = W.partitionBy("state").orderBy("m").rowsBetween(W.unboundedPreceding, 0)

    def mean_of_last(n: int) -> Column:
        last = months.rowsBetween(-(n - 1), 0)
        return F.when(F.count(F.lit(1)).over(last) >= n, F.avg("unemployment_rate").over(last))

    featured = monthly.withColumns(
        {
            "unemployment_rate_3m_avg": mean_of_last(3),
            "unemployment_rate_12m_avg": mean_of_last(12),
            "unemployment_change_3m": F.col("unemployment_rate")
            - _months_back("unemployment_rate", months, 3),
            "unemployment_change_12m": F.col("unemployment_rate")
            - _months_back("unemployment_rate", months, 12),
            "employment_growth_12m": growth("employment", _months_back("employment", months, 12)),
            "labor_force_growth_12m": growth(
                "labor_force", _months_back("labor_force", months, 12)
            ),
            "labor_publication_date": F.max("publication_date").over(everything),
            "_next": F.lead("m", 1).over(months),
        }
    )
    return featured.where(F.col("_next").isNull()).select(
        "state",
        F.col("date").alias("labor_month"),
        "unemployment_rate",
        "unemployment_rate_3m_avg",
        "unemployment_rate_12m_avg",
        "unemployment_change_3m",
        "unemployment_change_12m",
        "employment_growth_12m",
        "labor_force_growth_12m",
        "labor_publication_date",
    )


def latest_labor_month(labor: DataFrame, as_of: AsOf) -> DataFrame:
    """One row: the newest month of any state that was public on ``as_of``."""
    return latest_as_of(labor, as_of, ["state"], order_col="date", columns=[]).agg(
        F.max("date").alias("latest_labor_month")
    )


# Industry codes of private employment and their feature names.
INDUSTRY_SHARE_CODES = {
    "1011": "pct_natural_resources_mining",
    "1012": "pct_construction",
    "1013": "pct_manufacturing",
    "1021": "pct_trade_transportation_utilities",
    "1022": "pct_information",
    "1023": "pct_finance",
    "1024": "pct_professional_services",
    "1025": "pct_education_health",
    "1026": "pct_hospitality",
    "1027": "pct_other_services",
    "11": "pct_agriculture",
    "21": "pct_mining",
    "44-45": "pct_retail",
    "48-49": "pct_transportation",
    "61": "pct_education",
    "62": "pct_healthcare",
}


def industry_by_year(industry: DataFrame, also: Sequence[Column] = ()) -> DataFrame:
    """Per state and year the employment totals and each industry's employment, with
    further aggregates (``also``) from the same pass."""
    code, owner = F.col("industry_code"), F.col("own_code")
    is_total = (code == "10") & (owner == "0")

    def of_total(column: str) -> Column:
        return F.max(F.when(is_total, F.col(column)))

    def employment(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("annual_avg_employment")))

    return industry.groupBy("state", F.col("year").alias("industry_year")).agg(
        F.count_if(is_total).alias("_totals"),
        of_total("annual_avg_employment").alias("total_employment"),
        of_total("annual_avg_weekly_wage").alias("average_weekly_wage"),
        of_total("avg_annual_pay").alias("avg_annual_pay"),
        *[
            employment((owner == "5") & (code == industry_code)).alias(name)
            for industry_code, name in INDUSTRY_SHARE_CODES.items()
        ],
        employment((code == "10") & owner.isin("1", "2", "3")).alias("pct_government"),
        *also,
    )


def shares_of_newest_year(by_year: DataFrame) -> DataFrame:
    """Employment shares in the newest year of any state; states without a total for it are left out."""
    newest_year = by_year.agg(F.max("industry_year")).scalar()
    names = [*INDUSTRY_SHARE_CODES.values(), "pct_government"]
    return (
        by_year.where((F.col("industry_year") == newest_year) & (F.col("_totals") > 0))
        .withColumns({name: ratio(name, "total_employment") for name in names})
        .drop("_totals")
    )


def industry_shares(industry: DataFrame, as_of: AsOf | None) -> DataFrame:
    """Employment shares by industry in the newest public year (one year for
    all states); states without a total for that year are left out."""
    return shares_of_newest_year(industry_by_year(filter_as_of(industry, as_of)))


# The measures of the state accounts.
STATE_MEASURES = (
    "real_gdp", "nominal_gdp", "personal_income", "population", "per_capita_personal_income",
    "regional_price_parity", "real_personal_income", "real_per_capita_personal_income",
)
GROWTH_MEASURES = (
    "real_gdp", "nominal_gdp", "personal_income", "real_personal_income",
    "per_capita_personal_income",
)


def state_economy_features(state_economy: DataFrame, as_of: AsOf) -> DataFrame:
    """Newest year per state, measures as columns, with growth over the state's
    previous year at hand. A value revised later counts once it was public. Measures
    beyond the known eight become further columns; one distinct job finds them."""
    available = filter_as_of(state_economy, as_of).where(F.col("value").isNotNull())
    found = available.select("measure").where(~F.col("measure").isin(*STATE_MEASURES)).distinct()
    measures = [*STATE_MEASURES, *sorted(row.measure for row in found.collect())]
    order = [c for c in _REVISION_ORDER if c in available.columns]
    revision = F.struct(*order, "value")
    wide = (
        available.groupBy("state", "year")
        .pivot("measure", measures)
        .agg(F.max(revision))
        .select("state", "year", *[F.col(f"`{m}`.value").alias(m) for m in measures])
    )
    years = W.partitionBy("state").orderBy("year")
    grown = wide.withColumns(
        {f"{m}_growth": growth(m, F.lag(m, 1).over(years)) for m in GROWTH_MEASURES}
        | {"_next": F.lead("year", 1).over(years)}
    )
    return grown.where(F.col("_next").isNull()).select(
        "state",
        F.col("year").alias("state_economy_year"),
        *[f"`{m}`" for m in measures],
        *[f"{m}_growth" for m in GROWTH_MEASURES],
        ratio("real_gdp", "population").alias("real_gdp_per_capita"),
    )


# Series behind the national features: measure, adjusted or not.
NATIONAL_SERIES = {
    "unemployment": ("unemployment_rate", True),
    "participation": ("labor_force_participation_rate", True),
    "cpi": ("cpi_all_items", False),
    "cpi_adjusted": ("cpi_all_items", True),
    "core_cpi": ("cpi_core", False),
    "payrolls": ("nonfarm_payrolls", True),
    "earnings": ("average_hourly_earnings", True),
}


def _national_months(national: DataFrame, as_of: AsOf) -> DataFrame:
    """Newest public revision per (measure, adjustment, month), spread onto the
    series it feeds. A series takes the rows of its preferred adjustment, or all
    rows of the measure when it has none of those."""
    available = filter_as_of(national, as_of)
    if "seasonally_adjusted" not in available.columns:
        available = available.withColumn("seasonally_adjusted", F.lit(None).cast("boolean"))
    monthly = _newest_revision(
        available, as_of, ["measure", "seasonally_adjusted", "date"], ["value"]
    )
    member = F.array_compact(
        F.array(
            *[
                F.when(
                    F.col("measure") == measure,
                    F.struct(
                        F.lit(series).alias("series"),
                        F.coalesce(F.col("seasonally_adjusted") == wanted, F.lit(False)).alias(
                            "preferred"
                        ),
                    ),
                )
                for series, (measure, wanted) in NATIONAL_SERIES.items()
            ]
        )
    )
    spread = monthly.select(
        F.explode(member).alias("s"), "date", to_double("value").alias("value")
    ).select("s.series", "s.preferred", "date", "value")
    # At most two adjustments of each month of seven series are left here.
    whole = W.partitionBy("series")
    chosen = spread.withColumn("_any", F.max("preferred").over(whole)).where(
        F.col("preferred") | ~F.col("_any")
    )
    return top_per_key(chosen, ["series", "date"], [F.desc("value")], tie_break=False).drop("_any")


def national_features(national: DataFrame, as_of: AsOf) -> DataFrame:
    """One row of national conditions as they were known on ``as_of``."""
    months = _national_months(national, as_of).withColumn("m", month_number("date"))
    series = W.partitionBy("series").orderBy("m")
    newest_rows = months.withColumns(
        {f"back_{k}": _months_back("value", series, k) for k in (1, 3, 12)}
        | {"_next": F.lead("m", 1).over(series)}
    ).where(F.col("_next").isNull())

    def pick(name: str, value: Column | str) -> Column:
        column = F.col(value) if isinstance(value, str) else value
        return F.max(F.when(F.col("series") == name, column))

    def change(name: str, k: int) -> Column:
        return pick(name, growth("value", f"back_{k}"))

    quarter = change("cpi_adjusted", 3)
    row = newest_rows.agg(
        pick("unemployment", "value").alias("national_unemployment_rate"),
        pick("unemployment", F.col("value") - F.col("back_12")).alias(
            "national_unemployment_change_12m"
        ),
        pick("participation", "value").alias("national_labor_force_participation"),
        change("cpi", 12).alias("cpi_yoy"),
        change("cpi_adjusted", 1).alias("cpi_mom"),
        (F.pow(quarter + 1, F.lit(4.0)) - 1).alias("cpi_3m_annualized"),
        change("core_cpi", 12).alias("core_cpi_yoy"),
        pick("payrolls", "value").alias("nonfarm_payrolls"),
        change("payrolls", 1).alias("payroll_growth_1m"),
        change("payrolls", 3).alias("payroll_growth_3m"),
        change("payrolls", 12).alias("payroll_growth_12m"),
        change("earnings", 12).alias("wage_growth_12m"),
    )
    last_month = filter_as_of(national, as_of).agg(F.max("date").cast("string")).scalar()
    return row.withColumn(
        "real_wage_growth_12m",
        ratio(F.col("wage_growth_12m") + 1, F.col("cpi_yoy") + 1) - 1,
    ).withColumn("national_data_month", last_month)
