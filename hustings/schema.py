"""The 22 canonical tables as Spark schemas, and the coercion onto them.

A :class:`TableSpec` carries a ``StructType`` whose fields hold their unit in
the field metadata (the quality rules read it from there) and the natural key.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .errors import NormalizationError
from .functions import scalars as S

_TYPES = {
    "string": T.StringType(),
    "int64": T.LongType(),
    "float64": T.DoubleType(),
    "bool": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}

_CASTS = {
    T.LongType(): S.to_long,
    T.DoubleType(): S.to_double,
    T.BooleanType(): S.to_bool,
    T.DateType(): S.to_date,
    T.TimestampType(): S.to_timestamp,
}


def columns(kind: str, names: str, *, unit: str = "", required: bool = False) -> list[T.StructField]:
    """Fields of one kind; ``names`` is a blank-separated list."""
    meta = {"unit": unit} if unit else {}
    return [T.StructField(name, _TYPES[kind], not required, meta) for name in names.split()]


def text(names: str, required: bool = False) -> list[T.StructField]:
    return columns("string", names, required=required)


def whole(names: str, required: bool = False) -> list[T.StructField]:
    return columns("int64", names, required=required)


def number(names: str, unit: str = "") -> list[T.StructField]:
    return columns("float64", names, unit=unit)


def shares(names: str) -> list[T.StructField]:
    return columns("float64", names, unit="share 0-1")


def flags(names: str, required: bool = False) -> list[T.StructField]:
    return columns("bool", names, required=required)


def dates(names: str, required: bool = False) -> list[T.StructField]:
    return columns("date", names, required=required)


# Carried by every row of every table, for point-in-time correctness.
PROVENANCE = [
    *dates("observation_date period_start period_end publication_date"),
    *flags("publication_date_estimated", required=True),
    *dates("retrieval_date", required=True),
    *text("source", required=True),
    *text("source_url"),
    *text("dataset_id", required=True),
    *text("revision_vintage"),
    *text("ingestion_run_id", required=True),
]
PROVENANCE_NAMES = [field.name for field in PROVENANCE]


@dataclass(frozen=True)
class TableSpec:
    name: str
    key: tuple[str, ...]
    schema: T.StructType
    frequency: str = ""
    derived: bool = False
    # Snapshot tables keep every retrieval: as-of reads choose among them.
    snapshots: bool = False

    @property
    def names(self) -> list[str]:
        return self.schema.names

    @property
    def required(self) -> list[str]:
        return [field.name for field in self.schema if not field.nullable]

    def unit(self, column: str) -> str:
        return self.schema[column].metadata.get("unit", "")

    def empty(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([], self.schema)


def _table(
    name: str,
    frequency: str,
    key: str,
    *groups: Iterable[T.StructField],
    derived: bool = False,
    snapshots: bool = False,
) -> TableSpec:
    fields = [field for group in groups for field in group] + PROVENANCE
    return TableSpec(
        name, tuple(key.split()), T.StructType(fields), frequency, derived, snapshots
    )


_STATE = text("state state_fips", required=True)

# The names, types, units and keys of the canonical tables.
_ALL = [
    _table(
        "election_results", "per election",
        "state year office district candidate party_raw special",
        _STATE, whole("year", required=True), dates("election_date"),
        text("office district election_type", required=True), flags("special", required=True),
        text("candidate party_raw"), text("party", required=True), flags("writein"),
        number("votes total_votes", "votes"), flags("unofficial"),
    ),
    _table(
        "election_race_summary", "per election", "state year office district special",
        _STATE, whole("year", required=True), dates("election_date"),
        text("office district", required=True), flags("special", required=True),
        number("dem_votes rep_votes other_votes total_candidate_votes total_votes", "votes"),
        shares(
            "dem_vote_share rep_vote_share other_vote_share dem_two_party_share rep_two_party_share"
        ),
        number("dem_rep_margin", "share -1..1"), text("winner_party"),
        number("winning_margin", "share"), text("dem_candidate rep_candidate"),
        whole("n_candidates"), flags("uncontested"),
        derived=True,
    ),
    _table(
        "turnout", "biennial", "state year",
        _STATE, whole("year", required=True),
        number(
            "registered_voters active_registered_voters inactive_registered_voters "
            "citizen_voting_age_population voting_age_population",
            "persons",
        ),
        number(
            "ballots_cast in_person_election_day_votes early_votes mail_votes provisional_votes "
            "uocava_votes mail_ballots_transmitted mail_ballots_returned mail_ballots_rejected "
            "provisional_ballots_submitted",
            "ballots",
        ),
        whole("n_jurisdictions n_jurisdictions_missing_ballots"),
    ),
    _table(
        "demographics", "annual", "state year survey",
        _STATE, whole("year", required=True), text("survey", required=True),
        number("total_population", "persons"), number("median_age", "years"),
        shares(
            "pct_under_18 pct_18_24 pct_25_34 pct_35_44 pct_45_54 pct_55_64 pct_65_74 pct_75_plus "
            "pct_65_plus pct_male pct_female pct_less_than_high_school pct_high_school "
            "pct_some_college pct_associate_degree pct_bachelors pct_graduate_degree "
            "pct_bachelors_or_higher pct_high_school_or_higher"
        ),
        number("median_household_income mean_household_income per_capita_income", "USD (current)"),
        number("gini_coefficient", "0-1"),
        shares(
            "poverty_rate pct_white pct_white_non_hispanic pct_black pct_hispanic_latino pct_asian "
            "pct_native_american pct_native_hawaiian_pacific_islander pct_multiracial "
            "pct_other_race pct_foreign_born pct_naturalized_citizen pct_non_citizen "
            "pct_native_born"
        ),
        number("citizen_voting_age_population", "persons"),
    ),
    _table(
        "population", "annual", "state year revision_vintage",
        _STATE, whole("year", required=True), number("population births deaths", "persons"),
        number(
            "natural_change international_migration domestic_migration net_migration",
            "persons (net)",
        ),
        number("domestic_migration_rate net_migration_rate", "per 1000"),
    ),
    _table(
        "geography", "annual", "state year",
        _STATE, whole("year", required=True),
        number("land_area_sq_miles water_area_sq_miles", "sq mi"),
    ),
    _table(
        "urban_rural", "decennial", "state year",
        _STATE, whole("year", required=True),
        number("total_population urban_population rural_population", "persons"),
        shares("pct_urban pct_rural"),
    ),
    _table(
        "migration_flows", "annual", "origin_state destination_state year",
        text("origin_state destination_state", required=True), whole("year", required=True),
        number("movers movers_moe", "persons"),
    ),
    _table(
        "labor", "monthly", "state date seasonally_adjusted",
        _STATE, dates("date", required=True), flags("seasonally_adjusted", required=True),
        number("labor_force employment unemployment", "persons"),
        number("unemployment_rate", "percent 0-100"),
        snapshots=True,
    ),
    _table(
        "industry", "annual", "state year industry_code own_code",
        _STATE, whole("year", required=True), text("industry_code own_code", required=True),
        text("agglvl_code"), number("annual_avg_establishments", "establishments"),
        number("annual_avg_employment", "persons"),
        number("total_annual_wages annual_avg_weekly_wage avg_annual_pay", "USD"),
    ),
    _table(
        "state_economy", "annual", "state year measure",
        _STATE, whole("year", required=True), text("measure", required=True), number("value"),
        text("unit bea_table line_code"),
    ),
    _table(
        "national_economy", "monthly", "date series_id",
        dates("date", required=True), text("series_id measure", required=True), number("value"),
        flags("seasonally_adjusted"), text("unit"),
        snapshots=True,
    ),
    _table(
        "candidates", "continuous", "candidate_id cycle",
        text("candidate_id", required=True), whole("cycle", required=True), whole("election_year"),
        text(
            "name party_raw party office state state_fips district district_raw "
            "incumbent_challenger_status candidate_status principal_committee_id"
        ),
        snapshots=True,
    ),
    _table(
        "candidate_finance", "per report", "candidate_id cycle coverage_end_date revision_vintage",
        text("candidate_id", required=True), whole("cycle", required=True),
        text(
            "name party_raw party office state state_fips district incumbent_challenger_status"
        ),
        dates("coverage_end_date", required=True),
        number(
            "total_receipts transfers_from_authorized total_disbursements transfers_to_authorized "
            "cash_on_hand_beginning cash_on_hand_end candidate_contributions candidate_loans "
            "other_loans candidate_loan_repayments other_loan_repayments debts_owed_by "
            "individual_contributions other_committee_contributions party_contributions "
            "refunds_individual refunds_committee",
            "USD",
        ),
        snapshots=True,
    ),
    _table(
        "polls", "per poll", "poll_id state office district year",
        text("poll_id state", required=True), text("state_fips district"),
        text("office", required=True), whole("year", required=True),
        text("pollster pollster_grade sponsor"), dates("start_date end_date"),
        number("sample_size"), text("population_type mode dem_candidate rep_candidate"),
        shares("dem_pct rep_pct other_pct undecided_pct"), number("poll_margin", "share"),
    ),
    _table(
        "approval_polls", "per poll", "poll_id",
        text("poll_id", required=True), text("pollster president"), dates("start_date end_date"),
        number("sample_size"), text("population_type"), shares("approve disapprove"),
        number("net_approval", "share"),
    ),
    _table(
        "generic_ballot_polls", "per poll", "poll_id",
        text("poll_id", required=True), text("pollster"), dates("start_date end_date"),
        number("sample_size"), text("population_type"),
        shares("generic_dem generic_rep generic_other undecided"),
        number("generic_margin", "share"),
    ),
    _table(
        "special_elections", "per election", "state district office election_date",
        text("state", required=True), text("state_fips district"), text("office", required=True),
        dates("election_date", required=True), shares("dem_vote_share rep_vote_share"),
        number("actual_margin historical_baseline_margin special_election_swing", "share"),
    ),
    _table(
        "religion", "occasional", "state survey_year",
        _STATE, whole("survey_year", required=True),
        shares(
            "pct_christian pct_evangelical_protestant pct_mainline_protestant "
            "pct_historically_black_protestant pct_catholic pct_mormon pct_jewish pct_muslim "
            "pct_other_religion pct_religiously_unaffiliated pct_atheist pct_agnostic "
            "pct_religion_very_important pct_attend_weekly pct_pray_daily pct_highly_religious"
        ),
    ),
    _table(
        "naep", "biennial", "state assessment_year grade subject",
        _STATE, whole("assessment_year grade", required=True), text("subject", required=True),
        number("average_score", "scale score"),
        shares("pct_at_or_above_basic pct_at_or_above_proficient pct_advanced"),
    ),
    _table(
        "individual_turnout_cps", "biennial", "respondent_id year",
        text("respondent_id", required=True), whole("year", required=True),
        text("state state_fips"), number("age"), text("sex race"), flags("hispanic"),
        text("education income"), flags("registered voted"), number("weight"),
    ),
    _table(
        "individual_behavior_anes", "biennial", "respondent_id year",
        text("respondent_id", required=True), whole("year", required=True),
        text("state state_fips"), number("age"),
        text(
            "sex race education income religion party_id ideology presidential_vote_choice "
            "house_vote_choice senate_vote_choice"
        ),
        number("weight"),
    ),
]

TABLES: dict[str, TableSpec] = {spec.name: spec for spec in _ALL}


def table_spec(name: str) -> TableSpec:
    try:
        return TABLES[name]
    except KeyError as exc:
        raise NormalizationError(f"no canonical table named {name!r}") from exc


def enforce_schema(
    df: DataFrame, table: str | TableSpec, *, strict: bool = True, stored: bool = False
) -> DataFrame:
    """Coerce a frame to its table in one projection.

    Missing optional columns become NULL, missing required ones raise when
    ``strict``, further columns are dropped, values that do not convert become
    NULL, and the columns take the table's order. ``stored`` marks rows that have
    been through this before: columns of the right type pass as they are, so that
    filters on them still reach the scan.
    """
    spec = table if isinstance(table, TableSpec) else table_spec(table)
    have = {field.name: field.dataType for field in df.schema}
    missing = [name for name in spec.required if name not in have]
    if missing and strict:
        raise NormalizationError(f"table {spec.name!r} lacks required columns {missing}")
    out = []
    for field in spec.schema:
        if field.name not in have:
            value = F.lit(None).cast(field.dataType)
        elif have[field.name] == field.dataType and (
            stored or field.dataType != T.DoubleType()  # NaN becomes NULL
        ):
            value = F.col(field.name)
        elif field.dataType == T.BooleanType() and have[field.name] != T.StringType():
            value = F.col(field.name).try_cast("boolean")
        elif field.dataType in _CASTS:
            value = _CASTS[field.dataType](field.name)
        else:
            value = F.col(field.name).cast("string")
        out.append(value.alias(field.name, metadata=field.metadata))
    return df.select(out)
