"""Demographic, population, density and urban features as of a date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalars import growth, ratio
from .pit import AsOf, filter_as_of, latest_as_of
from .turnout import newest_vintage_per_year

# The profile columns that become features.
DEMOGRAPHIC_FEATURES = (
    "median_age pct_18_24 pct_25_34 pct_35_44 pct_45_54 pct_55_64 pct_65_74 pct_75_plus "
    "pct_65_plus pct_less_than_high_school pct_high_school pct_some_college "
    "pct_associate_degree pct_bachelors pct_graduate_degree pct_bachelors_or_higher "
    "median_household_income per_capita_income mean_household_income poverty_rate "
    "gini_coefficient pct_white_non_hispanic pct_black pct_hispanic_latino pct_asian "
    "pct_native_american pct_multiracial pct_native_born pct_naturalized_citizen "
    "pct_non_citizen pct_foreign_born citizen_voting_age_population"
).split()

MIGRATION = (
    "domestic_migration", "international_migration", "net_migration", "domestic_migration_rate",
    "net_migration_rate",
)

GROWTH_YEARS = (1, 4, 10)


def demographics_as_of(demographics: DataFrame, as_of: AsOf, *, survey: str = "acs1") -> DataFrame:
    """The newest profile per state that was public on ``as_of``."""
    rows = demographics
    if "survey" in rows.columns:
        rows = rows.where(F.col("survey") == survey)
    features = [c for c in DEMOGRAPHIC_FEATURES if c in rows.columns]
    needed = [*features, "total_population", "publication_date"]
    return latest_as_of(rows, as_of, ["state"], order_col="year", columns=needed).select(
        "state",
        F.col("year").alias("acs_year"),
        F.col("publication_date").alias("acs_publication_date"),
        *features,
        F.col("total_population").alias("acs_total_population"),
    )


def population_as_of(population: DataFrame, as_of: AsOf) -> DataFrame:
    """Per state the newest population year with its growth over 1, 4 and 10
    rows of the series made of each year's newest public vintage.

    The per-year choice shrinks the data to one row per state and year first,
    so the window that follows only ever sees a state's list of years.
    """
    needed = ["population", "publication_date", "revision_vintage"]
    needed += [c for c in MIGRATION if c in population.columns]
    series = newest_vintage_per_year(filter_as_of(population, as_of), needed)
    years = W.partitionBy("state").orderBy("year")
    grown = series.withColumns(
        {
            f"population_growth_{k}y": growth("population", F.lag("population", k).over(years))
            for k in GROWTH_YEARS
        }
        | {"_next": F.lead("year", 1).over(years)}
    )
    return grown.where(F.col("_next").isNull()).select(
        "state",
        F.col("year").alias("population_year"),
        "population",
        *[f"population_growth_{k}y" for k in GROWTH_YEARS],
        *[c for c in MIGRATION if c in population.columns],
        F.col("publication_date").alias("population_publication_date"),
        F.col("revision_vintage").alias("population_vintage"),
    )


def density_features(pop_features: DataFrame, geography: DataFrame, as_of: AsOf) -> DataFrame:
    area = "land_area_sq_miles"
    land = latest_as_of(geography, as_of, ["state"], order_col="year", columns=[area])
    return (
        pop_features.join(land.select("state", area), "state", "left")
        .withColumn("population_density", ratio("population", "land_area_sq_miles"))
        .withColumn("log_population_density", F.log1p("population_density"))
    )


def urban_features(urban_rural: DataFrame, as_of: AsOf) -> DataFrame:
    needed = ["pct_urban", "pct_rural"]
    latest = latest_as_of(urban_rural, as_of, ["state"], order_col="year", columns=needed)
    return latest.select(
        "state", "pct_urban", "pct_rural", F.col("year").alias("urban_rural_census_year")
    )


def snapshot(
    as_of: AsOf,
    *,
    demographics: DataFrame | None = None,
    population: DataFrame | None = None,
    geography: DataFrame | None = None,
    urban_rural: DataFrame | None = None,
) -> DataFrame:
    """Everything known per state on a date; states of any part are kept."""
    parts = []
    if demographics is not None:
        parts.append(demographics_as_of(demographics, as_of))
    if population is not None:
        people = population_as_of(population, as_of)
        parts.append(people if geography is None else density_features(people, geography, as_of))
    if urban_rural is not None:
        parts.append(urban_features(urban_rural, as_of))
    out = parts[0]
    for part in parts[1:]:
        out = out.join(part, "state", "full_outer")
    return out
