"""Assembly of the modelling table: one row per race with every feature family
as it was known on a date, and the provenance of each family."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import DatasetUnavailableError, PointInTimeError
from ..functions import geo
from ..functions.dates import cutoff, election_day
from ..session import materialize
from . import candidates as C
from . import demographics as D
from . import economics as E
from . import elections as L
from . import polls as P
from . import slices as S
from . import turnout as T
from .pit import AsOf, filter_as_of, latest_as_of
from .relational import attach_scalars, newest, top_per_key

OFFICES = ("president", "senate", "house")

# Passes over different tables at a time: they are independent, and most are small.
JOBS_AT_A_TIME = 3

# The outcome columns attached as labels.
TARGET_COLUMNS = (
    "dem_votes rep_votes other_votes total_votes total_candidate_votes dem_vote_share "
    "rep_vote_share dem_two_party_share dem_rep_margin winner_party winning_margin "
    "dem_candidate rep_candidate uncontested"
).split()

# The feature families and the table each one reads.
FAMILIES = {
    "targets": "election_results",
    "political_history": "election_results",
    "turnout": "turnout",
    "demographics": "demographics",
    "population": "population",
    "geography": "geography",
    "urban_rural": "urban_rural",
    "labor": "labor",
    "industry": "industry",
    "state_economy": "state_economy",
    "national_economy": "national_economy",
    "incumbency": "candidates",
    "finance": "candidate_finance",
    "race_polls": "polls",
    "approval": "approval_polls",
    "generic_ballot": "generic_ballot_polls",
    "special_elections": "special_elections",
    "naep": "naep",
    "religion": "religion",
}

# The assessments every state takes; further ones found in the data are added.
NAEP_CELLS = [("mathematics", 4), ("mathematics", 8), ("reading", 4), ("reading", 8)]


@dataclass
class FeatureBuild:
    """A lazy modelling table with the stored provenance of its families."""

    frame: DataFrame
    year: int
    office: str
    as_of: dt.date
    election_date: dt.date
    families: DataFrame

    def missingness(self) -> DataFrame:
        return missingness(self.frame)

    def audit(self) -> DataFrame:
        return audit_families(self.families, self.as_of, self.year)


def race_universe(
    office: str,
    year: int,
    summary: DataFrame,
    candidates: DataFrame | None,
    as_of: AsOf,
) -> DataFrame:
    """The races to build rows for: those with results; else, for president, all
    states and DC, for the others the races of known candidates; else the fifty
    states (none for the house). All tiers are one plan: the best tier that has
    rows is found by a scalar subquery, so nothing is counted on the driver.
    """
    spark = summary.sparkSession
    key = C.race_key(office)

    def tier(rows: DataFrame, rank: int) -> DataFrame:
        return rows.select(*key).distinct().withColumn("_tier", F.lit(rank))

    tiers = [tier(L.regular_races(summary, office).where(F.col("year") == year), 0)]
    states = geo.states_frame(spark)
    if office == "president":
        tiers.append(tier(states, 1))
    else:
        if candidates is not None:
            known = C.active_candidates(
                candidates.withColumn("election_year", F.lit(None).cast("bigint")),
                year, office, as_of,
            )
            tiers.append(tier(known.where(F.col("state").isin(*geo.FIFTY_STATES_DC)), 1))
        if office != "house":
            tiers.append(tier(states.where("is_state"), 2))
    every = reduce(DataFrame.unionByName, tiers)
    best = every.agg(F.min("_tier")).scalar()
    return every.where(F.col("_tier") == best).drop("_tier")


def history_before(
    summary: DataFrame, races: DataFrame, year: int, office: str, as_of: AsOf
) -> DataFrame:
    """Political history of the races to come: earlier public results plus one
    row without outcome per race, run through the history operator."""
    earlier = filter_as_of(summary, as_of).where(F.col("year") < year)
    upcoming = races.select(
        "state",
        "district" if "district" in races.columns else F.lit("statewide").alias("district"),
        F.lit(year).cast(summary.schema["year"].dataType).alias("year"),
        F.lit(office).alias("office"),
        F.lit(False).alias("special"),
    )
    both = earlier.unionByName(upcoming, allowMissingColumns=True)
    history = L.political_history(both, office).where(F.col("year") == year)
    drop = ["year", "office", "election_date"] + ([] if office == "house" else ["district"])
    return history.drop(*drop)


def turnout_before(
    turnout: DataFrame, population: DataFrame | None, year: int, as_of: AsOf
) -> DataFrame:
    """Turnout of each state's last public election of the same cycle type."""
    people = None if population is None else filter_as_of(population, as_of)
    metrics = T.turnout_metrics(filter_as_of(turnout, as_of), people)
    same_cycle = metrics.where(
        (F.col("year") < year) & (T.is_presidential_year("year") == F.lit(year % 4 == 0))
    )
    wanted = [
        "turnout_registered", "registered_voters", "ballots_cast", "turnout_population",
        "turnout_cvap", "mail_vote_share", "early_vote_share",
    ]
    names = [c for c in wanted if c in metrics.columns]
    last = top_per_key(same_cycle.select("state", "year", *names), ["state"], newest("year"))
    return last.select(
        "state",
        F.col("year").alias("prev_turnout_year"),
        *[F.col(c).alias(f"prev_{c}") for c in names],
    )


def _naep_names(cells: Sequence[tuple[str, int]]) -> list[str]:
    """A column name for each cell: four letters of the subject, or the whole subject
    where further cells share them at a grade. Spark's names know no case, so a
    number parts subjects that differ in it only."""
    shared = Counter((subject[:4].lower(), grade) for subject, grade in cells)
    names: list[str] = []
    taken: set[str] = set()
    for subject, grade in cells:
        fixed = (subject, grade) in NAEP_CELLS
        stem = subject[:4] if fixed or shared[subject[:4].lower(), grade] == 1 else subject
        name, n = f"naep_{stem}_grade{grade}", 1
        while name.lower() in taken:
            n += 1
            name = f"naep_{stem}_{n}_grade{grade}"
        taken.add(name.lower())
        names.append(name)
    return names


def naep_wide(naep: DataFrame, as_of: AsOf) -> DataFrame:
    """Newest public score per state, subject and grade, one column each: the four
    usual ones and, found by one distinct job, all others in the data."""
    latest = latest_as_of(
        naep, as_of, ["state", "grade", "subject"], order_col="assessment_year",
        columns=["average_score"],
    )
    found = naep.select("subject", "grade").where("subject is not null and grade is not null").distinct()
    more = sorted({(r.subject, int(r.grade)) for r in found.collect()} - set(NAEP_CELLS))
    cells = [*NAEP_CELLS, *more]
    return latest.groupBy("state").agg(
        *[
            F.max(
                F.when(
                    (F.col("subject") == subject) & (F.col("grade") == grade),
                    F.col("average_score"),
                )
            ).alias(name)
            for (subject, grade), name in zip(cells, _naep_names(cells), strict=True)
        ],
        F.max("assessment_year").alias("naep_year"),
    )


def religion_latest(religion: DataFrame, as_of: AsOf) -> DataFrame:
    shares = [c for c in religion.columns if c.startswith("pct_")]
    latest = latest_as_of(religion, as_of, ["state"], order_col="survey_year", columns=shares)
    return latest.select(
        "state", F.col("survey_year").alias("religion_survey_year"), *shares
    )


def usable_finance(finance: DataFrame, year: int, as_of: AsOf) -> DataFrame:
    """Finance rows of the cycle whose snapshot was retrieved by ``as_of``."""
    held = finance.where(
        (F.col("cycle") == year) & (F.to_date("retrieval_date") <= F.lit(cutoff(as_of)))
    )
    return filter_as_of(held, as_of)


# ------------------------------------------------------------------ provenance


_NOTES = {"targets": "labels, not filtered by as_of"}


def families_provenance(rows: Mapping[str, DataFrame | None], spark) -> DataFrame:
    """Provenance of every family, one row each: rows, datasets, runs, last publication day, and share
    of estimated publication days. One plan, one pass over the rows of each family."""
    facts = {name: None if df is None else S.facts_of(df) for name, df in rows.items()}
    return S.provenance(facts, _NOTES, spark)


def family_provenance(family: str, rows: DataFrame | None, spark) -> DataFrame:
    return families_provenance({family: rows}, spark)


def audit_families(families: DataFrame, as_of: AsOf, year: int) -> DataFrame:
    """Per family: available or not, last publication day, whether anything in it
    (labels aside) came out after the cut, and whether the cut lies before the
    election of ``year``."""
    late = F.col("max_publication_date") > F.lit(cutoff(as_of))
    return families.select(
        "family",
        (F.col("rows") > 0).alias("available"),
        "max_publication_date",
        F.col("publication_date_estimated_share").alias("estimated_share"),
        (F.coalesce(late, F.lit(False)) & (F.col("family") != "targets")).alias("post_as_of"),
        F.lit(cutoff(as_of) < election_day(year)).alias("forecast_before_election"),
    )


def verify_no_leakage(families: DataFrame, as_of: AsOf) -> None:
    audit = audit_families(families, as_of, cutoff(as_of).year)
    late = [row.family for row in audit.where("post_as_of").collect()]
    if late:
        raise PointInTimeError(f"published after {cutoff(as_of)}: {', '.join(late)}")


def missingness(df: DataFrame) -> DataFrame:
    """Share of NULLs per column, largest first, columns without any left out."""
    shares = df.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in df.columns])
    return (
        shares.unpivot([], df.columns, "column", "missing")
        .where(F.col("missing") > 0)
        .select("column", F.round("missing", 3).alias("missing"))
        .orderBy(F.desc("missing"), "column")
    )


def audit_features(
    tables: Mapping[str, DataFrame], year: int, office: str, as_of: AsOf | None = None
) -> DataFrame:
    """The audit of a build without assembling its frame."""
    cut = cutoff(as_of) if as_of is not None else election_day(year) - dt.timedelta(days=1)
    summary = _race_summaries(tables)
    rows = family_rows(tables, summary, year, office, cut)
    return audit_families(families_provenance(rows, summary.sparkSession), cut, year)


# -------------------------------------------------------------------- assembly


def _race_summaries(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Computed once and kept in the scratch folder: one row per race."""
    if "election_results" not in tables:
        raise DatasetUnavailableError("no election results loaded")
    return L.stored_summary(tables["election_results"])


def family_rows(
    tables: Mapping[str, DataFrame], summary: DataFrame, year: int, office: str, as_of: AsOf
) -> dict[str, DataFrame | None]:
    """The rows each family was allowed to use."""
    rows: dict[str, DataFrame | None] = {}
    for family, table in FAMILIES.items():
        source = tables.get(table)
        if family == "targets":
            rows[family] = L.regular_races(summary, office).where(F.col("year") == year)
        elif family == "political_history":
            rows[family] = filter_as_of(summary, as_of).where(F.col("year") < year)
        elif source is None:
            rows[family] = None
        elif family == "finance":
            rows[family] = usable_finance(source, year, as_of)
        else:
            rows[family] = filter_as_of(source, as_of, keep_unknown=family == "incumbency")
    return rows


def build_features(
    tables: Mapping[str, DataFrame],
    year: int,
    office: str,
    as_of: AsOf | None = None,
    *,
    states: Sequence[str] | None = None,
    strict: bool = True,
    summary: DataFrame | None = None,
) -> FeatureBuild:
    """The modelling table for ``office`` races of ``year`` as of a date (the day
    before the election unless given).

    Each table is passed over once: the pass leaves the rows that its features choose
    from and the facts of its provenance, which are stored (:mod:`slices`). The frame is a
    plan over these small tables and the race summaries; every family is reduced to
    one row per race or state before it is joined. Labels are attached unfiltered.
    ``strict`` runs the leakage audit now and raises on a violation. Pass the stored
    ``summary`` of all races where there is one; else it is computed and kept in
    the scratch folder.
    """
    office = office.lower()
    if office not in OFFICES:
        raise ValueError(f"office must be one of {OFFICES}")
    day = election_day(year)
    cut = cutoff(as_of) if as_of is not None else day - dt.timedelta(days=1)
    key = C.race_key(office)
    with ThreadPoolExecutor(JOBS_AT_A_TIME) as pool:
        races_of = pool.submit(lambda: _race_summaries(tables) if summary is None else summary)
        passes = {
            name: pool.submit(S.take, name, tables[name], year, office, cut) for name in S.PASSES if name in tables
        }
        summary = races_of.result()
        slices = {name: taken.result() for name, taken in passes.items()}
    rows = {name: taken.rows for name, taken in slices.items()}
    target = L.regular_races(summary, office).where(F.col("year") == year)
    races = materialize(race_universe(office, year, summary, rows.get("candidates"), cut), "races")
    # The history has by far the deepest plan: it is stored, so the frame's plan stays shallow.
    history = materialize(history_before(summary, races, year, office, cut), "history")
    families = materialize(_build_provenance(slices, target, summary, year, cut), "families")
    if strict:
        verify_no_leakage(families, cut)
    parts = _features(rows, year, office, cut, day)

    spark = summary.sparkSession
    if states:
        races = races.where(F.col("state").isin(*[s.upper() for s in states]))
    fips = geo.state_lookup(spark).where(F.length("state_token") == 2).where(
        F.col("state_token") == F.col("state")
    )
    frame = races.join(F.broadcast(fips.select("state", "state_fips")), "state", "left").select(
        "state",
        F.col("district") if "district" in key else F.lit("statewide").alias("district"),
        F.lit(year).cast("bigint").alias("year"),
        F.lit(office).alias("office"),
        "state_fips",
        F.lit(day).alias("election_date"),
        F.lit(cut).alias("as_of"),
    )
    if "state_economy" in parts and "population" in parts:
        # Both sources have a population; the estimate keeps the plain name.
        parts["state_economy"] = parts["state_economy"].withColumnRenamed("population", "state_economy_population")
    for name in _PER_STATE:
        if name in parts:
            frame = frame.join(parts[name], "state", "left")
    labels = target.select(*key, *[c for c in TARGET_COLUMNS if c in target.columns])
    for part in (labels, *[parts[name] for name in _PER_RACE if name in parts]):
        frame = frame.join(part, key, "left")
    frame = attach_scalars(frame, *[parts[name] for name in _ONE_ROW if name in parts])
    frame = frame.join(history, key, "left")
    return FeatureBuild(frame, year, office, cut, day, families)


# In the order of their columns in the frame.
_PER_STATE = (
    "turnout", "demographics", "population", "urban_rural", "labor", "industry", "state_economy", "naep", "religion",
)
_PER_RACE = ("candidates", "candidate_finance", "polls")
_ONE_ROW = ("national_economy", "approval_polls", "generic_ballot_polls", "special_elections")


def _features(
    rows: Mapping[str, DataFrame], year: int, office: str, cut: dt.date, day: dt.date
) -> dict[str, DataFrame]:
    """The features of each family at hand, from the rows that the passes left."""
    of_rows = {
        "turnout": lambda t: turnout_before(t, rows.get("population"), year, cut),
        "demographics": lambda t: D.demographics_as_of(t, cut),
        "population": lambda t: D.population_as_of(t, cut),
        "urban_rural": lambda t: D.urban_features(t, cut),
        "labor": lambda t: E.unemployment_features(t, cut),
        "industry": E.shares_of_newest_year,
        "state_economy": lambda t: E.state_economy_features(t, cut),
        "national_economy": lambda t: E.national_features(t, cut),
        "candidates": lambda t: C.incumbency_features(t, year, office, cut),
        "candidate_finance": lambda t: C.finance_features(t, year, office, cut),
        "polls": lambda t: P.race_poll_features(t, year, office, cut, day),
        "approval_polls": lambda t: P.approval_features(t, cut),
        "generic_ballot_polls": lambda t: P.generic_ballot_features(t, cut),
        "special_elections": lambda t: P.special_election_swing(t, cut),
        "naep": lambda t: naep_wide(t, cut),
        "religion": lambda t: religion_latest(t, cut),
    }
    parts = {name: of_rows[name](table) for name, table in rows.items() if name in of_rows}
    if "population" in parts and "geography" in rows:
        parts["population"] = D.density_features(parts["population"], rows["geography"], cut)
    return parts


def _build_provenance(
    slices: Mapping[str, S.Slice], target: DataFrame, summary: DataFrame, year: int, cut: dt.date
) -> DataFrame:
    """Provenance of the families from the facts that the passes left."""
    earlier = filter_as_of(summary, cut).where(F.col("year") < year)
    facts = {family: slices[table].facts if table in slices else None for family, table in FAMILIES.items()}
    facts |= {"targets": S.facts_of(target), "political_history": S.facts_of(earlier)}
    return S.provenance(facts, _NOTES, summary.sparkSession)
