"""Turnout rates and the previous comparable election's turnout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalars import ratio, to_double
from .relational import newest, top_per_key


# The counts that turnout rates are made of.
TURNOUT_COLUMNS = (
    "registered_voters", "ballots_cast", "mail_votes", "early_votes", "voting_age_population",
    "citizen_voting_age_population",
)


def newest_vintage_per_year(
    population: DataFrame, columns: Sequence[str] | None = None
) -> DataFrame:
    """One population row per state and year: the newest numeric vintage. Name
    the ``columns`` needed, so that the choice does not widen the scan."""
    numbered = population.withColumn("_vintage", to_double("revision_vintage"))
    if columns is not None:
        numbered = numbered.select(*dict.fromkeys(["state", "year", *columns, "_vintage"]))
    return top_per_key(numbered, ["state", "year"], newest("_vintage")).drop("_vintage")


def turnout_metrics(turnout: DataFrame, population: DataFrame | None = None) -> DataFrame:
    """Ballots over each denominator at hand, and the vote-method shares."""
    have = set(turnout.columns)
    out = turnout
    rates: dict[str, Column] = {"turnout_registered": ratio("ballots_cast", "registered_voters")}
    if "citizen_voting_age_population" in have:
        rates["turnout_cvap"] = ratio("ballots_cast", "citizen_voting_age_population")
        rates["registration_rate"] = ratio("registered_voters", "citizen_voting_age_population")
    if "voting_age_population" in have:
        rates["turnout_vap"] = ratio("ballots_cast", "voting_age_population")
    if population is not None:
        people = newest_vintage_per_year(population, ["population"])
        out = out.join(people, ["state", "year"], "left")
        rates["turnout_population"] = ratio("ballots_cast", "population")
    if "mail_votes" in have:
        rates["mail_vote_share"] = ratio("mail_votes", "ballots_cast")
    if "early_votes" in have:
        rates["early_vote_share"] = ratio("early_votes", "ballots_cast")
    return out.withColumns(rates)


def is_presidential_year(year: Column | str) -> Column:
    return (F.col(year) if isinstance(year, str) else year) % 4 == 0


def previous_turnout(metrics: DataFrame) -> DataFrame:
    """Turnout of the state's previous election of the same cycle type."""
    cycle = W.partitionBy("state", is_presidential_year("year")).orderBy("year")
    names = ["turnout_registered", "turnout_population", "ballots_cast"]
    return metrics.withColumns(
        {
            f"previous_{c}": F.lag(c, 1).over(cycle)
            for c in names
            if c in metrics.columns
        }
    )
