"""Queries over the readers, normalizers and the store."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators.features import build_features
from ..operators.relational import keep_last
from ..schema import enforce_schema
from ..session import scratch_dir
from ..sources import normalize as N
from ..sources import readers as R
from ..sources.registry import get_spec
from ..storage import load as ST
from ..storage.lake import Lake
from . import feeds  # noqa: F401  (registers the raw layouts)
from .bridge import AS_OF, YEAR
from .core import FEATURE_RATIOS, FEATURE_TABLES, features_oracle, provenance_oracle
from .registry import Tables, missing_shares, query

HELD = dt.date(2001, 12, 31)

# SQL of state resolution for feeds that hold USPS or FIPS codes only.
USPS = "(select state, state_fips, state_name from state_names)"


def _party(label: str) -> str:
    t = f"upper(trim(regexp_replace({label}, '\\s+', ' ', 'g')))"
    return f"""case when {label} is null then 'OTHER'
  when {t} in ('DEMOCRAT', 'DEMOCRATIC', 'DEMOCRATIC-FARMER-LABOR', 'DEM', 'DFL', 'DNL') then 'DEM'
  when {t} in ('REPUBLICAN', 'REPUBLICAN PARTY', 'REP') then 'REP'
  when {t} in ('LIBERTARIAN', 'LIB') then 'LIB'
  when {t} in ('GREEN', 'PACIFIC GREEN', 'GRE', 'GRN') then 'GRN'
  when {t} in ('INDEPENDENT', 'UNAFFILIATED', 'IND', 'NPA', 'NON') then 'IND'
  when {t} like 'DEMOCRAT%' then 'DEM' when {t} like 'REPUBLICAN%' then 'REP'
  when {t} like 'LIBERTARIAN%' then 'LIB' when regexp_matches({t}, '\\bGREEN\\b') then 'GRN'
  else 'OTHER' end"""


def _district(raw: str) -> str:
    return f"""case when {raw} is null or lower(trim({raw})) in ('', 'statewide') then 'statewide'
  when cast({raw} as int) = 0 then 'at-large' else lpad(cast(cast({raw} as int) as varchar), 2, '0') end"""


def _election_day(year: str) -> str:
    """The one Tuesday among November 2 to 8."""
    first = f"make_date({year}, 11, 2)"
    return f"{first} + cast((9 - isodow({first})) % 7 as int)"


_LINES = f"""
select cast(year as bigint) as year, state_po as state, {_district('district')} as district,
  case when runoff = 'TRUE' then 'runoff' when stage = 'gen' then 'general' else 'primary' end as election_type,
  special = 'true' as special, upper(trim(candidate)) as candidate, party as party_raw,
  {_party('party')} as party, cast(candidatevotes as double) as votes, cast(totalvotes as double) as total_votes,
  upper(mode) as mode from raw_returns"""
_MODES = f"""
select year, state, district, election_type, special, candidate, party_raw,
  case when count(*) filter (where mode = 'TOTAL') > 0 then sum(votes) filter (where mode = 'TOTAL')
    else sum(votes) end as votes, min(party) as party,
  case when count(*) filter (where mode = 'TOTAL') > 0 then min(total_votes) filter (where mode = 'TOTAL')
    else min(total_votes) end as total_votes
from ({_LINES}) l group by 1, 2, 3, 4, 5, 6, 7"""
_FUSED = f"""
select year, state, district, election_type, special, candidate, sum(votes) as votes,
  string_agg(party_raw, ' + ' order by votes desc, party_raw) as party_raw,
  arg_min(party, place) as party, arg_min(total_votes, place) as total_votes
from (select *, row_number() over (partition by year, state, district, election_type, special, candidate
  order by votes desc, party_raw) as place from ({_MODES}) m) x group by 1, 2, 3, 4, 5, 6"""


def _returns(t: Tables):
    return N.normalize_returns(t.sql("select * from raw_returns"), "house", "party")


@query(
    "nrm01_normalize_returns",
    f"""select f.year, f.state, n.state_fips, 'house' as office, district, election_type, special, candidate,
    party_raw, party, votes, total_votes, {_election_day('f.year')} as election_date,
    {_election_day('f.year')} as publication_date, true as publication_date_estimated
    from ({_FUSED}) f join {USPS} n on n.state = f.state where election_type = 'general'""",
)
def _(t: Tables):
    return _returns(t).select(
        "year", "state", "state_fips", "office", "district", "election_type", "special",
        "candidate", "party_raw", "party", "votes", "total_votes", "election_date",
        "publication_date", "publication_date_estimated",
    )


def _lines(t: Tables):
    raw = t.sql("select * from raw_returns")
    from ..functions.parties import normalize_party
    from ..functions.scalars import district_label, flag, to_double, to_long

    return raw.select(
        to_long("year").alias("year"),
        F.col("state_po").alias("state"),
        F.lit("house").alias("office"),
        district_label("district").alias("district"),
        F.when(flag("runoff"), F.lit("runoff"))
        .when(F.col("stage") == "gen", F.lit("general"))
        .otherwise(F.lit("primary"))
        .alias("election_type"),
        flag("special").alias("special"),
        F.upper(F.trim("candidate")).alias("candidate"),
        F.col("party").alias("party_raw"),
        normalize_party("party").alias("party"),
        to_double("candidatevotes").alias("votes"),
        to_double("totalvotes").alias("total_votes"),
        F.upper("mode").alias("mode"),
    )


@query("nrm02_collapse_modes", f"select * from ({_MODES}) m")
def _(t: Tables):
    return N.collapse_modes(_lines(t)).drop("office")


@query("nrm03_collapse_fusion", f"select * from ({_FUSED}) f")
def _(t: Tables):
    return N.collapse_fusion(N.collapse_modes(_lines(t))).drop("office")


@query(
    "nrm04_district_labels",
    f"select o_orderkey, {_district('d')} as district from (select o_orderkey, case when o_orderkey % 10 = 0 then ' ' when o_orderkey % 10 = 1 then 'Statewide' else cast(o_orderkey % 50 as varchar) end as d from orders) x",
)
def _(t: Tables):
    from ..functions.scalars import district_label

    k = F.col("o_orderkey")
    raw = (
        F.when(k % 10 == 0, F.lit(" "))
        .when(k % 10 == 1, F.lit("Statewide"))
        .otherwise((k % 50).cast("string"))
    )
    return t.base("orders").select("o_orderkey", district_label(raw).alias("district"))


@query(
    "nrm05_normalize_eavs",
    """select n.state, n.state_fips, cast(2022 as bigint) as year,
    sum(case when cast(A1a as double) >= 0 then cast(A1a as double) end) as registered_voters,
    sum(cast(A1b as double)) as active_registered_voters, sum(try_cast(F1a as double)) as ballots_cast,
    sum(case when cast(F1d as double) >= 0 then cast(F1d as double) end) as mail_votes,
    count(*) as n_jurisdictions, count(*) filter (where try_cast(F1a as double) is null) as n_jurisdictions_missing_ballots,
    date '2022-11-08' as observation_date
    from raw_eavs join state_names n on n.state = State_Abbr group by 1, 2""",
)
def _(t: Tables):
    out = N.normalize_eavs(t.sql("select * from raw_eavs"), 2022)
    return out.drop("state_name", "period_start", "period_end")


@query(
    "nrm06_version_from_url",
    "select page_id, case when page_id % 3 = 0 then null else concat('V', cast(1 + page_id % 4 as varchar), case when page_id % 2 = 0 then '.2' else '' end) end as version from pages",
)
def _(t: Tables):
    k = F.col("page_id")
    tag = F.concat(
        F.lit("/x_V"), (1 + k % 4).cast("string"), F.when(k % 2 == 0, F.lit(".2")).otherwise(F.lit("")),
        F.lit("_CSV.zip"),
    )
    url = F.when(k % 3 == 0, F.lit("/plain.zip")).otherwise(tag)
    return t.base("pages").select("page_id", N.version_from_url(url).alias("version"))


@query(
    "nrm07_normalize_pep",
    """select n.state, n.state_fips, v.year, v.population, v.births, v.natural_change, v.domestic_migration,
    v.net_migration_rate, '2024' as revision_vintage, make_date(v.year, 7, 1) as observation_date,
    date '2024-12-31' as publication_date
    from (
      select STATE, cast(2021 as bigint) as year, cast(POPESTIMATE2021 as double) as population, cast(BIRTHS2021 as double) as births,
        cast(null as double) as natural_change, cast(null as double) as domestic_migration, cast(null as double) as net_migration_rate
      from raw_pep where SUMLEV = '040'
      union all
      select STATE, 2022, cast(POPESTIMATE2022 as double), cast(BIRTHS2022 as double), cast(NATURALCHG2022 as double),
        cast(DOMESTICMIG2022 as double), cast(RNETMIG2022 as double) from raw_pep where SUMLEV = '040') v
    join state_names n on n.state_fips = lpad(v.STATE, 2, '0')""",
)
def _(t: Tables):
    return N.normalize_pep(t.sql("select * from raw_pep"), 2024).select(
        "state", "state_fips", "year", "population", "births", "natural_change",
        "domestic_migration", "net_migration_rate", "revision_vintage", "observation_date",
        "publication_date",
    )


@query(
    "nrm08_normalize_gazetteer",
    """select n.state, n.state_fips, n.state_name, sum(cast(ALAND_SQMI as double)) as land_area_sq_miles,
    sum(cast(AWATER_SQMI as double)) as water_area_sq_miles, cast(2020 as bigint) as year,
    date '2020-12-31' as publication_date
    from raw_gazetteer join state_names n on n.state = USPS group by 1, 2, 3""",
)
def _(t: Tables):
    return N.normalize_gazetteer(t.sql("select * from raw_gazetteer"), 2020).select(
        "state", "state_fips", "state_name", "land_area_sq_miles", "water_area_sq_miles", "year",
        "publication_date",
    )


@query(
    "nrm09_normalize_urban_rural",
    """select n.state, sum(cast(POP_COU as double)) as total_population,
    sum(cast(POP_URB as double)) / sum(cast(POP_COU as double)) as pct_urban,
    sum(cast(POP_RUR as double)) / sum(cast(POP_COU as double)) as pct_rural, date '2022-12-31' as publication_date
    from raw_urban u join state_names n on n.state_fips = u.STATE group by 1""",
    "pct_urban pct_rural",
)
def _(t: Tables):
    return N.normalize_urban_rural_county(t.sql("select * from raw_urban"), 2020).select(
        "state", "total_population", "pct_urban", "pct_rural", "publication_date"
    )


def _cell(name: str) -> str:
    return f"sum(case when variable = '{name}' and cast(value as double) >= -1000000 then cast(value as double) end)"


@query(
    "nrm10_normalize_acs",
    f"""select n.state, n.state_fips, cast(2021 as bigint) as year, 'acs1' as survey, {_cell('B01003_001E')} as total_population,
    {_cell('B19013_001E')} as median_household_income,
    {_cell('B01001_002E')} / {_cell('B01003_001E')} as pct_male,
    ({_cell('B01001_003E')} + {_cell('B01001_027E')}) / {_cell('B01003_001E')} as pct_under_18,
    {_cell('B15003_022E')} / {_cell('B15003_001E')} as pct_bachelors,
    {_cell('B15003_022E')} / {_cell('B15003_001E')} + {_cell('B15003_023E')} / {_cell('B15003_001E')} as pct_bachelors_or_higher,
    {_cell('B17001_002E')} / {_cell('B17001_001E')} as poverty_rate,
    ({_cell('B05002_013E')} - {_cell('B05002_014E')}) / {_cell('B05002_001E')} as pct_non_citizen,
    date '2022-09-30' as publication_date
    from raw_acs join state_names n on n.state_fips = state_code group by 1, 2""",
    "pct_male pct_under_18 pct_bachelors pct_bachelors_or_higher poverty_rate pct_non_citizen",
)
def _(t: Tables):
    return N.normalize_acs(t.sql("select * from raw_acs"), 2021, "acs1").select(
        "state", "state_fips", "year", "survey", "total_population", "median_household_income",
        "pct_male", "pct_under_18", "pct_bachelors", "pct_bachelors_or_higher", "poverty_rate",
        "pct_non_citizen", "publication_date",
    )


def _laus_value(code: str) -> str:
    return f"max(case when right(series_id, 2) = '{code}' then try_cast(value as double) end)"


@query(
    "nrm11_normalize_laus",
    f"""select * from (select n.state, n.state_fips, date, left(series_id, 5) = 'LASST' as seasonally_adjusted,
    {_laus_value('03')} as unemployment_rate, {_laus_value('04')} as unemployment, {_laus_value('05')} as employment,
    {_laus_value('06')} as labor_force, last_day(date) + 21 as publication_date, last_day(date) as period_end
    from raw_laus join state_names n on n.state_fips = substr(series_id, 6, 2) group by 1, 2, 3, 4) x
    where coalesce(unemployment_rate, unemployment, employment, labor_force) is not null""",
)
def _(t: Tables):
    series = t.sql("select * from raw_laus").withColumn("value", F.expr("try_cast(value as double)"))
    return N.normalize_laus(series).select(
        "state", "state_fips", "date", "seasonally_adjusted", "unemployment_rate", "unemployment",
        "employment", "labor_force", "publication_date", "period_end",
    )


@query(
    "nrm11_wanted_laus_series",
    "select * from raw_laus where left(series_id, 5) = 'LASST' and year(date) >= 1998",
)
def _(t: Tables):
    return N.wanted_laus_series(t.sql("select * from raw_laus"), 1998)


@query(
    "nrm13_normalize_national",
    """select date, series_id, case series_id when 'CUUR0000SA0' then 'cpi_all_items' when 'CUSR0000SA0' then 'cpi_all_items'
    when 'CUUR0000SA0L1E' then 'cpi_core' when 'CES0000000001' then 'nonfarm_payrolls' else 'unemployment_rate' end as measure,
    value, series_id not in ('CUUR0000SA0', 'CUUR0000SA0L1E') as seasonally_adjusted,
    last_day(date) + 15 as publication_date from raw_national""",
)
def _(t: Tables):
    return N.normalize_national(t.sql("select * from raw_national"), "bls_cpi").select(
        "date", "series_id", "measure", "value", "seasonally_adjusted", "publication_date"
    )


@query(
    "nrm14_normalize_qcew",
    """select n.state, n.state_fips, cast(2023 as bigint) as year, industry_code, own_code, agglvl_code,
    case when coalesce(trim(disclosure_code), '') <> 'N' then cast(annual_avg_estabs as double) end as annual_avg_establishments,
    case when coalesce(trim(disclosure_code), '') <> 'N' then cast(annual_avg_emplvl as double) end as annual_avg_employment,
    case when coalesce(trim(disclosure_code), '') <> 'N' then cast(total_annual_wages as double) end as total_annual_wages,
    case when coalesce(trim(disclosure_code), '') <> 'N' then cast(avg_annual_pay as double) end as avg_annual_pay,
    date '2024-06-30' as publication_date
    from raw_qcew join state_names n on n.state_fips = left(area_fips, 2) where agglvl_code in ('50', '51', '53', '54')""",
)
def _(t: Tables):
    return N.normalize_qcew(t.sql("select * from raw_qcew"), 2023).select(
        "state", "state_fips", "year", "industry_code", "own_code", "agglvl_code",
        "annual_avg_establishments", "annual_avg_employment", "total_annual_wages",
        "avg_annual_pay", "publication_date",
    )


@query(
    "nrm15_normalize_bea",
    """select n.state, n.state_fips, cast(TimePeriod as bigint) as year, 'real_gdp' as measure,
    try_cast(replace(DataValue, ',', '') as double) as value, CL_UNIT as unit, 'SAGDP9N' as bea_table, '1' as line_code,
    make_date(cast(TimePeriod as bigint) + 1, 9, 30) as publication_date
    from raw_bea join state_names n on n.state_fips = left(GeoFips, 2)""",
)
def _(t: Tables):
    raw = t.sql("select * from raw_bea")
    return N.normalize_bea(raw, "real_gdp", "SAGDP9N", "1", "bea_annual").select(
        "state", "state_fips", "year", "measure", "value", "unit", "bea_table", "line_code",
        "publication_date",
    )


_OFFICE = "case upper(CAND_OFFICE) when 'H' then 'house' when 'S' then 'senate' when 'P' then 'president' end"


@query(
    "nrm16_normalize_candidate_master",
    f"""select CAND_ID as candidate_id, cast(2000 as bigint) as cycle, cast(CAND_ELECTION_YR as bigint) as election_year,
    trim(CAND_NAME) as name, CAND_PTY_AFFILIATION as party_raw, {_party('CAND_PTY_AFFILIATION')} as party, office,
    case when office = 'president' then 'US' else n.state end as state, n.state_fips,
    case when office = 'house' then {_district('CAND_OFFICE_DISTRICT')} else 'statewide' end as district,
    upper(CAND_ICI) as incumbent_challenger_status, upper(CAND_STATUS) as candidate_status,
    CAND_PCC as principal_committee_id, date '2000-06-30' as publication_date
    from (select *, {_OFFICE} as office from raw_cn) c join state_names n on n.state = upper(CAND_OFFICE_ST)
    where office is not null""",
)
def _(t: Tables):
    return N.normalize_candidate_master(t.sql("select * from raw_cn"), 2000, HELD).select(
        "candidate_id", "cycle", "election_year", "name", "party_raw", "party", "office", "state",
        "state_fips", "district", "incumbent_challenger_status", "candidate_status",
        "principal_committee_id", "publication_date",
    )


@query(
    "nrm17_normalize_candidate_finance",
    f"""select CAND_ID as candidate_id, office, case when office = 'president' then 'US' else n.state end as state,
    {_party('CAND_PTY_AFFILIATION')} as party,
    case when office = 'house' then {_district('CAND_OFFICE_DISTRICT')} else 'statewide' end as district,
    covered as coverage_end_date, cast(TTL_RECEIPTS as double) as total_receipts, cast(COH_COP as double) as cash_on_hand_end,
    cast(TTL_INDIV_CONTRIB as double) as individual_contributions,
    least(covered + 20, date '2000-12-31') as publication_date
    from (select *, cast(strptime(CVG_END_DT, '%m/%d/%Y') as date) as covered,
      case left(CAND_ID, 1) when 'H' then 'house' when 'S' then 'senate' else 'president' end as office from raw_finance) c
    join state_names n on n.state = CAND_OFFICE_ST where covered is not null""",
)
def _(t: Tables):
    raw = t.sql("select * from raw_finance")
    return N.normalize_candidate_finance(raw, 2000, dt.date(2000, 12, 31)).select(
        "candidate_id", "office", "state", "party", "district", "coverage_end_date",
        "total_receipts", "cash_on_hand_end", "individual_contributions", "publication_date",
    )


@query(
    "nrm18_candidate_district",
    f"""select CAND_ID as candidate_id, case when upper(CAND_OFFICE) = 'H' then {_district('CAND_OFFICE_DISTRICT')}
    else 'statewide' end as district from raw_cn""",
)
def _(t: Tables):
    office = F.when(F.upper("CAND_OFFICE") == "H", F.lit("house")).otherwise(F.lit("other"))
    return t.sql("select * from raw_cn").select(
        F.col("CAND_ID").alias("candidate_id"),
        N.candidate_district(office, "CAND_OFFICE_DISTRICT").alias("district"),
    )


def _stat(kind: str) -> str:
    return f"max(case when stattype = '{kind}' and isStatDisplayable <> 0 then value end)"


@query(
    "nrm19_normalize_naep",
    f"""select n.state, cast(year as bigint) as assessment_year, cast(grade as bigint) as grade,
    case subject when 'MAT' then 'mathematics' else 'reading' end as subject, {_stat('MN:MN')} as average_score,
    (100 - {_stat('ALD:BB')}) / 100 as pct_at_or_above_basic,
    ({_stat('ALD:PR')} + {_stat('ALD:AD')}) / 100 as pct_at_or_above_proficient, {_stat('ALD:AD')} / 100 as pct_advanced,
    case when year in (2009, 2017, 2024) then make_date(year + 1, 6, 30) else make_date(year, 12, 31) end as publication_date
    from raw_naep join state_names n on n.state = jurisdiction group by 1, 2, 3, 4, year""",
    "pct_at_or_above_basic pct_at_or_above_proficient pct_advanced",
)
def _(t: Tables):
    return N.normalize_naep(t.sql("select * from raw_naep")).select(
        "state", "assessment_year", "grade", "subject", "average_score", "pct_at_or_above_basic",
        "pct_at_or_above_proficient", "pct_advanced", "publication_date",
    )


def _share(c: str) -> str:
    return f"case when cast({c} as double) <= 1 then cast({c} as double) else cast({c} as double) / 100 end"


@query(
    "nrm20_normalize_approval_polls",
    f"""select poll_id, pollster, {_share('approve')} as approve, {_share('disapprove')} as disapprove,
    {_share('approve')} - {_share('disapprove')} as net_approval, cast(sample_size as double) as sample_size,
    cast(end_date as date) as end_date, cast(publication_date as date) as publication_date,
    false as publication_date_estimated from raw_approval""",
    "approve disapprove net_approval",
)
def _(t: Tables):
    return N.normalize_approval_polls(t.sql("select * from raw_approval")).select(
        "poll_id", "pollster", "approve", "disapprove", "net_approval", "sample_size", "end_date",
        "publication_date", "publication_date_estimated",
    )


@query(
    "nrm21_normalize_generic_ballot",
    f"""select poll_id, {_share('generic_dem')} as generic_dem, {_share('generic_rep')} as generic_rep,
    {_share('generic_other')} as generic_other, {_share('generic_dem')} - {_share('generic_rep')} as generic_margin,
    cast(start_date as date) as start_date, cast(publication_date as date) as publication_date from raw_generic""",
    "generic_dem generic_rep generic_other generic_margin",
)
def _(t: Tables):
    return N.normalize_generic_ballot(t.sql("select * from raw_generic")).select(
        "poll_id", "generic_dem", "generic_rep", "generic_other", "generic_margin", "start_date",
        "publication_date",
    )


@query(
    "nrm22_normalize_race_polls",
    f"""select poll_id, case state when 'pennsylvania' then 'PA' when 'OH' then 'OH' when ' new  york ' then 'NY'
    when '6' then 'CA' when '36' then 'NY' else 'DC' end as state, coalesce(district, 'statewide') as district, 'senate' as office,
    cast(2024 as bigint) as year, {_share('dem_pct')} as dem_pct, {_share('rep_pct')} as rep_pct,
    {_share('dem_pct')} - {_share('rep_pct')} as poll_margin, cast(end_date as date) as end_date from raw_polls""",
    "dem_pct rep_pct poll_margin",
)
def _(t: Tables):
    return N.normalize_race_polls(t.sql("select * from raw_polls")).select(
        "poll_id", "state", "district", "office", "year", "dem_pct", "rep_pct", "poll_margin",
        "end_date",
    )


@query(
    "nrm25_normalize_religion",
    f"""select r.state, n.state_fips, cast(survey_year as bigint) as survey_year, {_share('pct_catholic')} as pct_catholic,
    cast(pct_attend_weekly as double) as pct_attend_weekly, cast(publication_date as date) as publication_date,
    survey_year as revision_vintage, make_date(cast(survey_year as bigint), 12, 31) as period_end
    from raw_religion r join state_names n on n.state = r.state""",
    "pct_catholic",
)
def _(t: Tables):
    return N.normalize_religion(t.sql("select * from raw_religion")).select(
        "state", "state_fips", "survey_year", "pct_catholic", "pct_attend_weekly",
        "publication_date", "revision_vintage", "period_end",
    )


@query(
    "nrm23_shares_and_numbers",
    "select poll_id, case when cast(approve as double) <= 1 then cast(approve as double) else cast(approve as double) / 100 end as approve, try_cast(sample_size as double) as sample_size from raw_approval",
    "approve",
)
def _(t: Tables):
    from ..functions.scalars import share, to_double

    return t.sql("select * from raw_approval").select(
        "poll_id", share("approve").alias("approve"), to_double("sample_size").alias("sample_size")
    )


@query(
    "nrm24_poll_dates",
    """select poll_id, cast(start_date as date) as start_date, cast(end_date as date) as end_date,
    cast(publication_date as date) as publication_date, cast(end_date as date) as observation_date,
    cast(start_date as date) as period_start, cast(end_date as date) as period_end,
    false as publication_date_estimated from raw_approval""",
)
def _(t: Tables):
    rows = t.sql("select poll_id, start_date, end_date, publication_date from raw_approval")
    return N._poll_dates(rows)


@query(
    "nrm26_add_provenance",
    """select state, date, least(last_day(date) + 21, date '2000-12-31') as publication_date, 'BLS' as source,
    'bls-laus' as dataset_id, date '2000-12-31' as retrieval_date, 'run-1' as ingestion_run_id,
    'https://example.org/x' as source_url, true as publication_date_estimated, date as observation_date from (
    select distinct state, date from labor) l""",
)
def _(t: Tables):
    rows = t("labor").select("state", "date").distinct().select(
        "state", "date",
        F.date_add(F.last_day("date"), 21).alias("publication_date"),
        F.lit(True).alias("publication_date_estimated"),
        F.col("date").alias("observation_date"),
    )
    return ST.add_provenance(
        rows, get_spec("bls-laus"), retrieval_date=dt.date(2000, 12, 31), run_id="run-1",
        source_url="https://example.org/x",
    )


@query(
    "nrm27_keep_last",
    """select state, year, revision_vintage, population from (select *, row_number() over (partition by state, year
    order by publication_date desc, revision_vintage desc) as rn from population) p where rn = 1""",
)
def _(t: Tables):
    last = keep_last(t("population"), ["state", "year"], ("publication_date", "revision_vintage"))
    return last.select("state", "year", "revision_vintage", "population")


@query(
    "nrm28_enforce_schema",
    """select poll_id, pollster, cast(null as varchar) as president, cast(start_date as date) as start_date,
    try_cast(sample_size as double) as sample_size, cast(approve as double) as approve,
    cast(null as double) as net_approval, false as publication_date_estimated,
    date '2024-12-31' as retrieval_date, 'Polling' as source from raw_approval""",
)
def _(t: Tables):
    raw = t.sql("select * from raw_approval").withColumns(
        {
            "publication_date_estimated": F.lit(" No "),
            "retrieval_date": F.lit("2024-12-31"),
            "source": F.lit("Polling"),
            "dataset_id": F.lit("polls-approval"),
            "ingestion_run_id": F.lit("r"),
            "unknown_column": F.lit(1),
        }
    )
    return enforce_schema(raw, "approval_polls").select(
        "poll_id", "pollster", "president", "start_date", "sample_size", "approve", "net_approval",
        "publication_date_estimated", "retrieval_date", "source",
    )


def _fresh_lake(t: Tables, purpose: str) -> Lake:
    return Lake(t.spark, scratch_dir(t.spark, purpose))


@query(
    "nrm29_load",
    """select n.state, n.state_fips, cast(2022 as bigint) as year, sum(case when cast(A1a as double) >= 0 then cast(A1a as double) end) as registered_voters,
    sum(try_cast(F1a as double)) as ballots_cast, 'EAC' as source, 'eac-eavs' as dataset_id,
    date '2023-06-30' as publication_date
    from raw_eavs join state_names n on n.state = State_Abbr group by 1, 2""",
)
def _(t: Tables):
    lake = _fresh_lake(t, "load")
    rows = N.normalize_eavs(t.sql("select * from raw_eavs"), 2022).withColumns(
        {
            "publication_date": F.lit(dt.date(2023, 6, 30)),
            "publication_date_estimated": F.lit(True),
        }
    )
    result = ST.load(lake, "eac-eavs", rows, retrieval_date=dt.date(2024, 1, 1))
    if not result.ok:
        raise RuntimeError(result.error)
    return lake.read_table("turnout").select(
        "state", "state_fips", "year", "registered_voters", "ballots_cast", "source", "dataset_id",
        "publication_date",
    )


# ---------------------------------------------------------------------- readers


def _landed(t: Tables, name: str, **options) -> str:
    """The raw layout written as files, as a download would have left it."""
    path = scratch_dir(t.spark, name)
    t.sql(f"select * from {name}").write.options(**options).csv(path)
    return path


@query("src01_read_returns_file", "select * from raw_returns")
def _(t: Tables):
    path = _landed(t, "raw_returns", header=True, sep="\t", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return R.read_returns_file(t.spark, path)


@query("src02_read_latin_csv", "select * from raw_pep")
def _(t: Tables):
    path = _landed(t, "raw_pep", header=True, encoding=R.LATIN_1)
    return R.read_latin_csv(t.spark, path)


@query("src03_read_gazetteer", "select * from raw_gazetteer")
def _(t: Tables):
    return R.read_gazetteer(t.spark, _landed(t, "raw_gazetteer", header=True, sep="\t"))


@query("src04_read_county_csv", "select * from raw_urban")
def _(t: Tables):
    return R.read_csv(t.spark, _landed(t, "raw_urban", header=True))


_ACS_BODY = """select concat('f', cast(o_orderkey % 4 as string)) as file,
  concat('[["NAME","B01003_001E","state"],["', c_name, '","', cast(o_orderkey as string), '","',
  lpad(cast(c_nationkey as string), 2, '0'), '"]]') as value from orders join customer on o_custkey = c_custkey"""


@query(
    "src05_parse_acs_json",
    """select variable, value, count(*) as n from (
    select 'NAME' as variable, c_name as value from orders join customer on o_custkey = c_custkey union all
    select 'B01003_001E', cast(o_orderkey as varchar) from orders join customer on o_custkey = c_custkey union all
    select 'state', lpad(cast(c_nationkey as varchar), 2, '0') from orders join customer on o_custkey = c_custkey) c
    group by 1, 2""",
)
def _(t: Tables):
    cells = R.parse_acs_cells(t.sql(_ACS_BODY))
    return cells.groupBy("variable", "value").agg(F.count(F.lit(1)).alias("n"))


@query(
    "src05_acs_cells_by_state",
    """select variable, value, lpad(cast(c_nationkey as varchar), 2, '0') as state_code, count(*) as n from (
    select 'NAME' as variable, c_name as value, c_nationkey from orders join customer on o_custkey = c_custkey union all
    select 'B01003_001E', cast(o_orderkey as varchar), c_nationkey from orders join customer on o_custkey = c_custkey) c
    group by 1, 2, 3""",
)
def _(t: Tables):
    # One response per file: its rows are told apart by their number in it.
    bodies = t.sql(_ACS_BODY).withColumn("file", F.concat("file", F.lit("-"), F.xxhash64("value").cast("string")))
    cells = N.acs_cells_by_state(R.parse_acs_cells(bodies))
    return cells.groupBy("variable", "value", "state_code").agg(F.count(F.lit(1)).alias("n"))


@query(
    "src06_response_problem",
    """select page_id, case page_id % 5 when 0 then 'empty' when 1 then 'auth' when 2 then 'schema' when 3 then 'parse'
    end as problem from pages""",
)
def _(t: Tables):
    k = F.col("page_id")
    body = (
        F.when(k % 5 == 0, F.lit("  "))
        .when(k % 5 == 1, F.concat(F.lit("\n<html><title>Invalid Key</title>"), "html"))
        .when(k % 5 == 2, F.concat(F.lit("<p>"), F.regexp_replace("html", "(?i)<title>", "<t>")))
        .when(k % 5 == 3, F.concat(F.lit("[[1,"), F.substring("url", 1, 5)))
        .otherwise(F.lit('[["NAME"],["x"]]'))
    )
    return t.base("pages").select("page_id", R.response_problem(body).alias("problem"))


_SERIES_BODY = """select concat('{"status":"REQUEST_SUCCEEDED","Results":{"series":[{"seriesID":"S', cast(o_custkey % 9 as string),
  '","data":[{"year":"', cast(year(o_orderdate) as string), '","period":"',
  case when o_orderkey % 13 = 0 then 'M13' else concat('M', lpad(cast(month(o_orderdate) as string), 2, '0')) end,
  '","value":"', case when o_orderkey % 7 = 0 then '-' else cast(o_orderkey as string) end,
  '","footnotes":[{"text":"p"},{}]}]}]}}') as value, 'f' as file from orders"""


@query(
    "src07_parse_series_json",
    """select concat('S', cast(o_custkey % 9 as varchar)) as series_id, cast(date_trunc('month', o_orderdate) as date) as date,
    case when o_orderkey % 7 = 0 then null else cast(o_orderkey as double) end as value, 'p' as footnotes
    from orders where o_orderkey % 13 <> 0""",
)
def _(t: Tables):
    return R.parse_series(t.sql(_SERIES_BODY))


@query(
    "src08_read_laus_flat_file",
    """select series_id, date, try_cast(value as double) as value from raw_laus""",
)
def _(t: Tables):
    path = scratch_dir(t.spark, "raw_laus")
    padded = t.sql("select * from raw_laus").select(
        F.concat(F.lit(" "), "series_id", F.lit("   ")).alias("series_id   "),
        F.year("date").cast("string").alias("year"),
        F.date_format("date", "'M'MM").alias("period"),
        F.lpad("value", 12, " ").alias("       value"),
    )
    padded.write.options(
        header=True, sep="\t", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)
    return R.read_laus_flat_file(t.spark, path)


@query(
    "src09_read_industry_files",
    "select area_fips, industry_code, annual_avg_emplvl, cast(2023 as bigint) as year from raw_qcew",
)
def _(t: Tables):
    path = f"{scratch_dir(t.spark, 'raw_qcew')}/qcew_2023_42.csv"
    t.sql("select * from raw_qcew").write.option("header", True).csv(path)
    # The folder carries the name of the file; the year comes from it.
    df = R.read_csv(t.spark, path)
    return R.with_file_year(df).select(
        "area_fips", "industry_code", "annual_avg_emplvl", "year"
    )


@query("src10_read_turnout_survey", "select * from raw_eavs")
def _(t: Tables):
    return R.read_csv(t.spark, _landed(t, "raw_eavs", header=True))


@query("src11_read_pipe_file", "select * replace (cast(CAND_ST1 as varchar) as CAND_ST1, cast(CAND_ST2 as varchar) as CAND_ST2) from raw_cn")
def _(t: Tables):
    path = scratch_dir(t.spark, "raw_cn")
    rows = t.sql("select * from raw_cn")
    line = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in N.CANDIDATE_LAYOUT])
    rows.select(line).write.text(path)
    return R.read_pipe_file(t.spark, path, N.CANDIDATE_LAYOUT)


_SCORE_BODY = """select concat('{"status":200,"result":[{"year":', cast(year(o_orderdate) as string), ',"grade":8,"subject":"MAT","jurisdiction":"',
  o_orderstatus, '","stattype":"MN:MN","value":', cast(o_orderkey % 300 as string), ',"isStatDisplayable":1,"errorFlag":0}]}') as value, 'f' as file from orders
  union all select '{"status":200,"result":[]}' as value, 'g' as file from region"""


@query(
    "src12_parse_scores_json",
    """select cast(year(o_orderdate) as int) as year, 8 as grade, 'MAT' as subject, o_orderstatus as jurisdiction,
    cast(o_orderkey % 300 as double) as value from orders""",
)
def _(t: Tables):
    return R.parse_scores(t.sql(_SCORE_BODY)).select(
        "year", "grade", "subject", "jurisdiction", "value"
    )


_ACCOUNT_BODY = """select concat('{"BEAAPI":{"Results":{"Data":[{"GeoFips":"', lpad(cast(o_custkey % 50 as string), 2, '0'),
  '000","TimePeriod":"', cast(year(o_orderdate) as string), '","DataValue":"', cast(o_orderkey as string), ',000.5"}]}}}') as value,
  'f' as file from orders"""


@query(
    "src13_parse_accounts_json",
    """select concat(lpad(cast(o_custkey % 50 as varchar), 2, '0'), '000') as GeoFips, cast(year(o_orderdate) as varchar) as TimePeriod,
    concat(cast(o_orderkey as varchar), ',000.5') as DataValue from orders""",
)
def _(t: Tables):
    return R.parse_accounts(t.sql(_ACCOUNT_BODY)).select("GeoFips", "TimePeriod", "DataValue")


@query(
    "src14_read_manual_csvs",
    "select poll_id, approve, cast(null as varchar) as generic_dem from raw_approval union all select poll_id, null, generic_dem from raw_generic",
)
def _(t: Tables):
    path = scratch_dir(t.spark, "manual")
    for name, column in (("raw_approval", "approve"), ("raw_generic", "generic_dem")):
        t.sql(f"select poll_id, {column} from {name}").write.mode("append").option(
            "header", True
        ).csv(path)
    return R.read_manual_csvs(t.spark, path)


# ------------------------------------------------------------------------ store


@query("src15_read_parquet", "select o_orderkey, o_orderstatus from orders")
def _(t: Tables):
    lake = Lake(t.spark, t.sf_dir)
    return lake.read_parquet(f"{t.sf_dir}/orders.parquet").select("o_orderkey", "o_orderstatus")


@query(
    "src16_read_table_union",
    """select state, year, office, candidate, votes, 'a' as dataset_id from election_results where year <= 1998
    union all select state, year, office, candidate, votes, 'b' from election_results where year > 1998""",
)
def _(t: Tables):
    lake = _fresh_lake(t, "union")
    rows = t("election_results")
    lake.write_processed(rows.where("year <= 1998"), "election_results", "a")
    lake.write_processed(rows.where("year > 1998"), "election_results", "b")
    return lake.read_table("election_results").select(
        "state", "year", "office", "candidate", "votes", "dataset_id"
    )


def _stored_features(t: Tables, office: str):
    """The build of all feature tables, stored."""
    lake = _fresh_lake(t, "features")
    build = build_features(t.many(FEATURE_TABLES), YEAR, office, AS_OF)
    return lake, lake.write_features(build)


@query("src19_load_features", features_oracle("president"), FEATURE_RATIOS)
def _(t: Tables):
    lake, path = _stored_features(t, "president")
    return lake.load_features(path)


@query("snk01_write_parquet", "select l_orderkey, l_quantity from lineitem")
def _(t: Tables):
    lake = _fresh_lake(t, "parquet")
    path = lake.write_parquet(t.base("lineitem").select("l_orderkey", "l_quantity"), f"{lake.root}/x")
    return lake.read_parquet(path)


@query(
    "snk02_replace_dataset",
    """select state, year, registered_voters + 1 as registered_voters, 'eac-eavs' as dataset_id from turnout
    union all select state, year, registered_voters, 'other' from turnout""",
)
def _(t: Tables):
    lake = _fresh_lake(t, "replace")
    rows = t("turnout")
    lake.write_processed(rows, "turnout", "eac-eavs")
    lake.write_processed(rows, "turnout", "other")
    changed = rows.withColumn("registered_voters", F.col("registered_voters") + 1)
    lake.write_processed(changed, "turnout", "eac-eavs")
    return lake.read_table("turnout").select("state", "year", "registered_voters", "dataset_id")


@query(
    "snk03_write_staging",
    "select *, 'eac-eavs' as dataset_id, date '2024-01-01' as retrieval_date from raw_eavs",
)
def _(t: Tables):
    lake = _fresh_lake(t, "staging")
    lake.write_staging(t.sql("select * from raw_eavs"), "eac-eavs", "2024-01-01")
    return lake.read_parquet(f"{lake.root}/staging")


@query(
    "snk04_table_inventory",
    "select 'naep' as \"table\", 'naep-state' as dataset_id, count(*) as rows, 20 as columns from naep",
)
def _(t: Tables):
    lake = _fresh_lake(t, "inventory")
    lake.write_processed(t("naep"), "naep", "naep-state")
    return lake.inventory().select("table", "dataset_id", "rows", "columns")


@query(
    "snk05_manifest_upsert",
    """select run_id, case when event_id % 2 = 0 then 'success' else status end as status, row_count
    from (select *, cast(right(run_id, 12) as bigint) as event_id from ingestion_runs) r""",
)
def _(t: Tables):
    from ..storage.manifest import upsert

    records = t("ingestion_runs").select("run_id", "status", "row_count")
    number = F.substring("run_id", -12, 12).cast("bigint")
    ended = records.where(number % 2 == 0).withColumn("status", F.lit("success"))
    return upsert(records, ended)


@query(
    "snk05_manifest_latest_record",
    """select run_id, case when status = 'failed' then 'failed' else 'success' end as status from ingestion_runs""",
)
def _(t: Tables):
    from ..storage.manifest import latest_records

    runs = t("ingestion_runs")
    started = runs.select(
        "run_id", F.lit("running").alias("status"), F.col("started_at").alias("recorded_at"),
        F.lit(None).cast("timestamp_ntz").alias("completed_at"),
    )
    final = F.when(F.col("status") == "failed", F.lit("failed")).otherwise(F.lit("success"))
    ended = runs.select(
        "run_id", final.alias("status"),
        (F.col("started_at") + F.expr("interval 1 minute")).alias("recorded_at"),
        F.col("completed_at"),
    )
    return latest_records(started.unionByName(ended)).select("run_id", "status")


@query(
    "snk06_manifest_coerce",
    """select run_id, cast(null as varchar) as source, dataset, status, cast(null as date) as retrieval_date,
    row_count, cast(null as bigint) as validation_errors, error from ingestion_runs""",
)
def _(t: Tables):
    from ..storage.manifest import coerce

    runs = t("ingestion_runs").withColumn("row_count", F.col("row_count").cast("string"))
    return coerce(runs).select(
        "run_id", "source", "dataset", "status", "retrieval_date", "row_count",
        "validation_errors", "error",
    )


@query("snk07_feature_metadata", provenance_oracle("senate"))
def _(t: Tables):
    lake, _path = _stored_features(t, "senate")
    meta = t.spark.read.json(f"{lake.root}/features_metadata/office=senate/year={YEAR}")
    return meta.select(
        "family", "rows", "datasets", F.col("max_publication_date").cast("date").alias("max_publication_date"),
        F.col("publication_date_estimated_share").alias("estimated_share"),
    )


@query(
    "snk07_feature_build",
    f"""select m."column", m.missing, r.rows from ({missing_shares(features_oracle('house'))}) m
    cross join (select count(*) as rows from ({features_oracle('house')}) f) r""",
)
def _(t: Tables):
    lake, _path = _stored_features(t, "house")
    about = t.spark.read.schema("rows bigint, missingness map<string,double>").json(
        f"{lake.root}/features_builds/office=house/year={YEAR}"
    )
    return about.select("rows", F.explode("missingness").alias("column", "missing")).select("column", "missing", "rows")


@query(
    "snk08_views",
    "select state, count(*) as n from turnout group by state",
)
def _(t: Tables):
    lake = _fresh_lake(t, "views")
    lake.write_processed(t("turnout"), "turnout", "eac-eavs")
    if lake.rebuild_views() != ["turnout"]:
        raise RuntimeError("unexpected views")
    return lake.query("select state, count(*) as n from turnout group by state")
