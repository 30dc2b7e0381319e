"""Queries over the point-in-time, election, panel and poll operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..operators import candidates as C
from ..operators import demographics as D
from ..operators import economics as E
from ..operators import elections as L
from ..operators import features as X
from ..operators import pit
from ..operators import polls as P
from ..operators import turnout as TO
from ..operators.relational import weighted_mean
from .bridge import AS_OF, YEAR
from .checks import RACE, T, history, newest, weighted, window
from .registry import Tables, missing_shares, query

SHARES = (
    "dem_vote_share rep_vote_share other_vote_share dem_two_party_share rep_two_party_share "
    "dem_rep_margin winning_margin"
)
LEAN = (
    "pres_dem_two_party_share national_dem_two_party_share state_partisan_lean weighted_state_lean"
)
HISTORY = (
    "prev_dem_share prev_dem_vote_share prev_rep_share prev_margin average_dem_share_last_2 "
    "average_dem_share_last_3 previous_swing " + LEAN
)
GROWTH = "population_growth_1y population_growth_4y population_growth_10y"
TURNOUT = (
    "turnout_registered turnout_cvap registration_rate turnout_population mail_vote_share "
    "early_vote_share"
)
JOBS = (
    "unemployment_rate unemployment_rate_3m_avg unemployment_rate_12m_avg unemployment_change_3m "
    "unemployment_change_12m employment_growth_12m labor_force_growth_12m"
)
MIX = " ".join([*E.INDUSTRY_SHARE_CODES.values(), "pct_government"])
ACCOUNTS = " ".join([f"{m}_growth" for m in E.GROWTH_MEASURES] + ["real_gdp_per_capita"])
NATION = (
    "national_unemployment_change_12m cpi_yoy cpi_mom cpi_3m_annualized core_cpi_yoy "
    "payroll_growth_1m payroll_growth_3m payroll_growth_12m wage_growth_12m real_wage_growth_12m"
)
MONEY = "dem_fundraising_share log_dem_receipts log_rep_receipts"
RACE_POLLS = (
    "state_poll_margin state_poll_dem state_poll_rep polling_average_7d polling_average_30d "
    "polling_uncertainty"
)
APPROVAL = (
    " ".join(f"approval_average_{d}d net_approval_{d}d" for d in (7, 30, 90)) + " approval_change_30d"
)
GENERIC = (
    " ".join(f"generic_margin_{d}d" for d in (7, 30, 90))
    + " generic_ballot_dem_30d generic_ballot_rep_30d generic_change_30d"
)
SWINGS = " ".join(f"special_election_swing_{d}d" for d in (30, 90, 180))

# ---------------------------------------------------------------- point in time


@query("pit01_filter_as_of", f"select * from election_results where publication_date <= {T}")
def _(t: Tables):
    return pit.filter_as_of(t("election_results"), AS_OF)


@query(
    "pit01_filter_as_of_keep_unknown",
    f"""select candidate_id, cycle, day from (select *, case when cycle = 1998 then null else publication_date end as day
    from candidates) c where day <= {T} or day is null""",
)
def _(t: Tables):
    rows = t("candidates").select(
        "candidate_id",
        "cycle",
        F.when(F.col("cycle") != 1998, F.col("publication_date")).alias("day"),
    )
    return pit.filter_as_of(rows, AS_OF, publication_col="day", keep_unknown=True)


@query(
    "pit01_filter_as_of_fallback",
    f"select state, year, retrieval_date from turnout where retrieval_date <= {T}",
)
def _(t: Tables):
    rows = t("turnout").select("state", "year", "retrieval_date")
    return pit.filter_as_of(rows, AS_OF)


@query(
    "pit02_latest_as_of",
    f"""select state, year, revision_vintage, population, publication_date from ({newest(
        'population', 'state', 'year publication_date revision_vintage', f'publication_date <= {T}')}) p""",
)
def _(t: Tables):
    latest = pit.latest_as_of(
        t("population"), AS_OF, ["state"], order_col="year", columns=["population"]
    )
    return latest.select("state", "year", "revision_vintage", "population", "publication_date")


@query(
    "pit02_latest_vintage_per_year",
    f"""select state, year, revision_vintage, population from ({newest(
        'population', 'state, year', 'publication_date revision_vintage', f'publication_date <= {T}')}) p""",
)
def _(t: Tables):
    latest = pit.latest_as_of(t("population"), AS_OF, ["state", "year"], order_col="year")
    return latest.select("state", "year", "revision_vintage", "population")


@query(
    "pit03_future_rows",
    f"""select count(*) filter (where publication_date > {T}) as future_rows,
    max(publication_date) as max_publication_date from population""",
)
def _(t: Tables):
    return pit.future_rows(t("population"), AS_OF)


@query(
    "pit04_leakage_report",
    f"""select '{AS_OF}' as as_of, count(*) as rows, 'publication_date' as publication_column,
    count(*) filter (where publication_date > {T}) as rows_after_as_of,
    count(*) filter (where publication_date is null) as rows_unknown_publication,
    count(*) filter (where publication_date <= {T}) as rows_available,
    count(*) filter (where publication_date_estimated) as estimated_publication_rows,
    cast(max(publication_date) as varchar) as max_publication_date from candidate_finance""",
)
def _(t: Tables):
    return pit.leakage_report(t("candidate_finance"), AS_OF)


@query(
    "pit06_clip_estimated_publication",
    """select o_orderkey, case when o_orderkey % 3 <> 0 and pub > retrieved then retrieved else pub end as publication_date
    from (select o_orderkey, cast(o_orderdate as date) + 20 as pub, last_day(cast(o_orderdate as date)) as retrieved
    from orders) o""",
)
def _(t: Tables):
    day = F.to_date("o_orderdate")
    return t.base("orders").select(
        "o_orderkey",
        pit.clip_estimated(
            F.date_add(day, 20), F.col("o_orderkey") % 3 != 0, F.last_day(day)
        ).alias("publication_date"),
    )


@query(
    "pit07_release_rules",
    """select day, last_day(day) as month_end, last_day(day) + 21 as bls_laus_state, last_day(day) + 15 as bls_cpi,
    last_day(day) + 8 as bls_employment_situation, make_date(y + 1, 6, 30) as bls_qcew_annual,
    make_date(y + 1, 9, 30) as acs_1year, make_date(y + 1, 12, 31) as acs_5year,
    make_date(y, 12, 31) as pep_vintage, make_date(y, 12, 31) as census_geography,
    make_date(y + 2, 12, 31) as urban_rural, make_date(y + 1, 9, 30) as bea_annual,
    make_date(y + 1, 12, 31) as bea_rpp,
    case when y + 12 in (2009, 2017, 2024) then make_date(y + 13, 6, 30) else make_date(y + 12, 12, 31) end as naep,
    day + 20 as fec_summary
    from (select distinct cast(o_orderdate as date) as day, year(o_orderdate) as y from orders) d""",
)
def _(t: Tables):
    days = t.base("orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    by_day = ("month_end", "bls_laus_state", "bls_cpi", "bls_employment_situation", "fec_summary")
    rules = {
        name: cal.apply_rule(name, F.col("day") if name in by_day else F.year("day"))
        for name in cal.RULES
        if name != "naep"
    }
    return days.withColumns(rules | {"naep": cal.apply_rule("naep", F.year("day") + 12)})


@query(
    "pit08_url_month_folder",
    """select page_id, case when page_id % 4 = 0 then null
    else last_day(make_date(2000 + page_id % 20, 1 + page_id % 12, 1)) end as published from pages""",
)
def _(t: Tables):
    page = F.col("page_id")
    month = F.lpad((1 + page % 12).cast("string"), 2, "0")
    folder = F.concat(F.lit("/files/"), (2000 + page % 20).cast("string"), F.lit("-"), month)
    url = F.when(page % 4 == 0, F.col("url")).otherwise(F.concat("url", folder, F.lit("/x.zip")))
    return t.base("pages").select("page_id", cal.from_url_month_folder(url).alias("published"))


@query(
    "pit09_apply_rule",
    """select o_orderkey, case when o_orderkey % 9 = 0 then null
    else last_day(cast(o_orderdate as date)) + 21 end as published from orders""",
)
def _(t: Tables):
    day = F.when(F.col("o_orderkey") % 9 != 0, F.to_date("o_orderdate"))
    return t.base("orders").select(
        "o_orderkey", cal.apply_rule("bls_laus_state", day).alias("published")
    )


# -------------------------------------------------------------------- elections


@query("ele01_race_summary", "select * from races", SHARES)
def _(t: Tables):
    return L.race_summary(t("election_results"))


@query(
    "ele02_derived_metrics",
    f"""select {RACE}, dem_votes, rep_votes, other_votes, total_candidate_votes, dem_vote_share, rep_vote_share,
    other_vote_share, dem_two_party_share, rep_two_party_share, dem_rep_margin from races""",
    "dem_vote_share rep_vote_share other_vote_share dem_two_party_share rep_two_party_share dem_rep_margin",
)
def _(t: Tables):
    totals = L.candidate_lines(t("election_results")).groupBy(*L.RACE_KEY).agg(
        *[
            F.sum(F.when(F.col("party") == p, F.col("votes"))).alias(f"{n}_votes")
            for p, n in (("DEM", "dem"), ("REP", "rep"))
        ],
        F.sum(F.when(~F.col("party").isin("DEM", "REP"), F.col("votes"))).alias("other_votes"),
    )
    return L.derived_metrics(totals)


@query(
    "ele03_national_two_party_share",
    """select year, sum(dem_votes) / nullif(sum(dem_votes) + sum(rep_votes), 0) as national_dem_two_party_share
    from races where office = 'president' and not special group by year""",
    "national_dem_two_party_share",
)
def _(t: Tables):
    return L.national_two_party_share(L.stored_summary(t("election_results")))


@query("ele04_presidential_lean", "select * exclude (l1, l2, l3) from lean_races", LEAN)
def _(t: Tables):
    return L.presidential_lean(L.stored_summary(t("election_results")))


for _office in ("president", "senate", "house"):

    @query(
        f"ele05_previous_same_office_{_office}",
        f"""select state, district, office, year, prev_dem_share as prev_dem_two_party_share, prev_dem_vote_share,
        prev_rep_share as prev_rep_vote_share, prev_margin as prev_dem_rep_margin, prev_winner_party,
        prev_total_candidate_votes, prev_election_year from ({history('races', _office)}) h""",
        "prev_dem_two_party_share prev_dem_vote_share prev_rep_vote_share prev_dem_rep_margin",
    )
    def _(t: Tables, office=_office):
        return L.previous_same_office(L.stored_summary(t("election_results")), office)

    @query(f"ele06_political_history_{_office}", history('races', _office), HISTORY)
    def _(t: Tables, office=_office):
        return L.political_history(L.stored_summary(t("election_results")), office)


@query(
    "ele07_rebuild_race_summary",
    f"""select {RACE}, election_date, dem_votes, rep_votes, other_votes, total_candidate_votes, total_votes,
    winner_party, dem_candidate, rep_candidate, n_candidates, uncontested, dem_two_party_share, winning_margin
    from races""",
    "dem_two_party_share winning_margin",
)
def _(t: Tables):
    from ..session import scratch_dir
    from ..storage.lake import Lake
    from ..storage.load import rebuild_race_summary

    lake = Lake(t.spark, scratch_dir(t.spark, "derived"))
    lake.write_processed(t("election_results"), "election_results", "medsl-senate")
    rebuild_race_summary(lake)
    return lake.read_table("election_race_summary").select(
        *L.RACE_KEY, "election_date", "dem_votes", "rep_votes", "other_votes",
        "total_candidate_votes", "total_votes", "winner_party", "dem_candidate", "rep_candidate",
        "n_candidates", "uncontested", "dem_two_party_share", "winning_margin",
    )


# ---------------------------------------------------------------------- turnout


@query("trn01_turnout_metrics", "select * from metrics", TURNOUT)
def _(t: Tables):
    return TO.turnout_metrics(t("turnout"), t("population"))


@query(
    "trn02_newest_vintage_per_year",
    "select state, year, population, revision_vintage from people_any",
)
def _(t: Tables):
    return TO.newest_vintage_per_year(t("population"), ["population", "revision_vintage"])


@query(
    "trn03_previous_turnout",
    """select state, year, turnout_registered, ballots_cast,
    lag(turnout_registered) over c as previous_turnout_registered,
    lag(turnout_population) over c as previous_turnout_population,
    lag(ballots_cast) over c as previous_ballots_cast
    from metrics window c as (partition by state, year % 4 = 0 order by year)""",
    "turnout_registered previous_turnout_registered previous_turnout_population",
)
def _(t: Tables):
    metrics = TO.turnout_metrics(t("turnout"), t("population"))
    return TO.previous_turnout(metrics).select(
        "state", "year", "turnout_registered", "ballots_cast", "previous_turnout_registered",
        "previous_turnout_population", "previous_ballots_cast",
    )


# ----------------------------------------------------------------- demographics


@query("dem01_demographics_as_of", "select * from acs", "pct_bachelors poverty_rate")
def _(t: Tables):
    return D.demographics_as_of(t("demographics"), AS_OF)


@query("dem02_population_as_of", "select * from population_growth", GROWTH)
def _(t: Tables):
    return D.population_as_of(t("population"), AS_OF)


@query(
    "dem03_density_features", "select * from density",
    GROWTH + " population_density log_population_density",
)
def _(t: Tables):
    people = D.population_as_of(t("population"), AS_OF)
    return D.density_features(people, t("geography"), AS_OF)


@query("dem04_urban_features", "select * from urban", "pct_urban pct_rural")
def _(t: Tables):
    return D.urban_features(t("urban_rural"), AS_OF)


# -------------------------------------------------------------------- economics


@query("eco01_unemployment_features", "select * from jobs", JOBS)
def _(t: Tables):
    return E.unemployment_features(t("labor"), AS_OF)


@query("eco02_industry_shares", "select * from industry_mix", MIX)
def _(t: Tables):
    return E.industry_shares(t("industry"), AS_OF)


@query("eco03_state_economy_features", "select * from accounts", ACCOUNTS)
def _(t: Tables):
    return E.state_economy_features(t("state_economy"), AS_OF)


@query("eco04_national_features", "select * from national_row", NATION)
def _(t: Tables):
    return E.national_features(t("national_economy"), AS_OF)


@query(
    "eco05_latest_labor_month",
    f"select max(date) as latest_labor_month from labor where publication_date <= {T}",
)
def _(t: Tables):
    return E.latest_labor_month(t("labor"), AS_OF)


@query(
    "eco06_month_floor",
    "select distinct cast(date_trunc('month', l_shipdate) as date) as month from lineitem",
)
def _(t: Tables):
    from ..functions.dates import month_floor

    return t.base("lineitem").select(
        month_floor(F.to_date("l_shipdate")).alias("month")
    ).distinct()


# ---------------------------------------------------------- candidates and polls

for _office, _key in (("senate", "state"), ("house", "state, district")):

    @query(f"can01_incumbency_{_office}", f"select * from incumbency_{_office}")
    def _(t: Tables, office=_office):
        return C.incumbency_features(t("candidates"), YEAR, office, AS_OF)

    @query(f"can02_finance_{_office}", f"select * from finance_{_office}", MONEY)
    def _(t: Tables, office=_office):
        return C.finance_features(t("candidate_finance"), YEAR, office, AS_OF)

    @query(f"pol04_race_polls_{_office}", f"select * from race_polls_{_office}", RACE_POLLS)
    def _(t: Tables, office=_office):
        return P.race_poll_features(t("polls"), YEAR, office, AS_OF, "2000-11-07")


@query(
    "pol01_poll_window",
    f"select poll_id, end_date, publication_date, approve from approval_polls where {window(30)}",
)
def _(t: Tables):
    return P.poll_window(t("approval_polls"), AS_OF, 30).select(
        "poll_id", "end_date", "publication_date", "approve"
    )


@query("pol02_approval_features", "select * from approval", APPROVAL)
def _(t: Tables):
    return P.approval_features(t("approval_polls"), AS_OF)


@query("pol03_generic_ballot_features", "select * from generic", GENERIC)
def _(t: Tables):
    return P.generic_ballot_features(t("generic_ballot_polls"), AS_OF)


@query("pol05_special_election_swing", "select * from swings", SWINGS)
def _(t: Tables):
    return P.special_election_swing(t("special_elections"), AS_OF)


@query(
    "pol06_weighted_mean",
    f"""select state, office, {weighted('dem_pct', 'sample_size', 'true')} as weighted,
    {weighted('dem_pct', 'sample_size', 'event_free')} as weighted_some, avg(dem_pct) as plain
    from (select *, end_date > date '2000-09-10' as event_free from polls) p group by state, office""",
    "weighted weighted_some plain",
)
def _(t: Tables):
    return t("polls").groupBy("state", "office").agg(
        weighted_mean("dem_pct", "sample_size").alias("weighted"),
        weighted_mean("dem_pct", "sample_size", "end_date > date'2000-09-10'").alias("weighted_some"),
        weighted_mean("dem_pct", None).alias("plain"),
    )


# --------------------------------------------------------------------- features

FEATURE_TABLES = (
    "election_results turnout population demographics geography urban_rural labor industry "
    "state_economy national_economy candidates candidate_finance polls approval_polls "
    "generic_ballot_polls special_elections naep religion"
)

TARGETS = (
    "dem_vote_share rep_vote_share dem_two_party_share dem_rep_margin winning_margin"
)
FEATURE_RATIOS = " ".join(
    [
        TARGETS, HISTORY,
        "prev_turnout_registered prev_turnout_population prev_turnout_cvap prev_mail_vote_share "
        "prev_early_vote_share pct_bachelors poverty_rate",
        GROWTH, "population_density log_population_density pct_urban pct_rural", JOBS, MIX,
        ACCOUNTS, NATION, MONEY, RACE_POLLS, APPROVAL, GENERIC, SWINGS,
        "pct_catholic pct_evangelical_protestant pct_attend_weekly",
    ]
)


def features_oracle(office: str) -> str:
    house = office == "house"
    key = "state, district" if house else "state"
    races = f"select distinct state, {'district' if house else chr(39) + 'statewide' + chr(39) + ' as district'} from races where year = {YEAR} and office = '{office}' and not special"
    drop = "year, office, election_date" + ("" if house else ", district")
    hist = f"select * exclude ({drop}) from ({history('before', office)}) h where year = {YEAR}"
    targets = ", ".join(X.TARGET_COLUMNS)
    by_state = [
        "turnout_before", "acs", "density", "urban", "jobs", "industry_mix",
        "(select * rename (population as state_economy_population) from accounts)", "scores", "faith",
    ]
    joins = f"({races}) r left join (select state, state_fips from state_names) n using (state)"
    joins += f" left join (select {key}, {targets} from races where year = {YEAR} and office = '{office}' and not special) t using ({key})"
    joins += f" left join ({hist}) h using ({key})"
    for name in by_state:
        joins += f" left join {name} using (state)"
    for name in ("incumbency", "finance", "race_polls"):
        joins += f" left join {name}_{office} using ({key})"
    joins += " cross join national_row cross join approval cross join generic cross join swings"
    sql = f"""
select * replace (cast({YEAR} as bigint) as year) from (
  select *, cast({YEAR} as bigint) as year, '{office}' as office, date '2000-11-07' as election_date, {T} as as_of
  from {joins}) x"""
    return sql


for _office in ("president", "senate", "house"):

    @query(f"fea01_build_features_{_office}", features_oracle(_office), FEATURE_RATIOS)
    def _(t: Tables, office=_office):
        return X.build_features(t.many(FEATURE_TABLES), YEAR, office, AS_OF).frame


@query(
    "fea02_race_universe_results",
    f"select distinct state, district from races where year = {YEAR} and office = 'house' and not special",
)
def _(t: Tables):
    summary = L.stored_summary(t("election_results"))
    return X.race_universe("house", YEAR, summary, t("candidates"), AS_OF)


@query(
    "fea02_race_universe_candidates",
    """select distinct state, district from candidates where office = 'house' and cycle = 2000
    and not exists (select 1 from races where year = 2010)
    and publication_date <= date '2000-10-20' and coalesce(candidate_status, 'C') in ('C', 'N')""",
)
def _(t: Tables):
    # No results for the cycle yet: the races come from the candidates.
    summary = L.stored_summary(t("election_results")).where(F.col("year") < YEAR)
    return X.race_universe("house", YEAR, summary, t("candidates"), AS_OF)


@query(
    "fea02_race_universe_states",
    """select n.state, count(r.state) as earlier_races, max(r.year) as last_year from state_names n
    left join races r on r.state = n.state and r.office = 'president' and not r.special
    where (n.state = 'DC' or n.is_state) and not exists (select 1 from races where year = 2040) group by 1""",
)
def _(t: Tables):
    # Neither results nor candidates of the cycle: every state, with what it had before.
    summary = L.stored_summary(t("election_results"))
    earlier = L.regular_races(summary, "president").groupBy("state").agg(
        F.count(F.lit(1)).alias("n"), F.max("year").alias("last_year")
    )
    races = X.race_universe("president", 2040, summary, t("candidates"), AS_OF)
    return races.join(earlier, "state", "left").select(
        "state", F.coalesce("n", F.lit(0)).alias("earlier_races"), "last_year"
    )


@query(
    "fea03_family_provenance",
    f"""select 'labor' as family, count(*) as rows, list_sort(list(distinct dataset_id)) as datasets,
    list_sort(list(distinct ingestion_run_id)) as ingestion_runs, max(publication_date) as max_publication_date,
    round(avg(cast(publication_date_estimated as int)), 3) as publication_date_estimated_share, '' as note
    from labor where publication_date <= {T}""",
)
def _(t: Tables):
    return X.family_provenance("labor", pit.filter_as_of(t("labor"), AS_OF), t.spark)


def _audit(t: Tables):
    return X.audit_features(t.many(FEATURE_TABLES), YEAR, "senate", AS_OF)


def _family_sources(office: str):
    """Family, its source and which rows of it a build may use."""
    for family, table in X.FAMILIES.items():
        where = f"publication_date <= {T}"
        source = table
        if family == "targets":
            source, where = "races", f"year = {YEAR} and office = '{office}' and not special"
        elif family == "political_history":
            source, where = "races", f"publication_date <= {T} and year < {YEAR}"
        elif family == "finance":
            where += f" and cycle = {YEAR} and retrieval_date <= {T}"
        elif family == "incumbency":
            where += " or publication_date is null"
        yield family, source, where


def audit_oracle() -> str:
    return " union all ".join(
        f"""select '{family}' as family, count(*) > 0 as available, max(publication_date) as max_publication_date,
        round(avg(cast(publication_date_estimated as int)), 3) as estimated_share, false as post_as_of, true as forecast_before_election
        from {source} where {where}"""
        for family, source, where in _family_sources("senate")
    )


def provenance_oracle(office: str) -> str:
    return " union all ".join(
        f"""select '{family}' as family, count(*) as rows, list_sort(coalesce(list(distinct dataset_id), [])) as datasets,
        max(publication_date) as max_publication_date, round(avg(cast(publication_date_estimated as int)), 3) as estimated_share
        from {source} where {where}"""
        for family, source, where in _family_sources(office)
    )


@query("fea05_audit_features", audit_oracle())
def _(t: Tables):
    return _audit(t)


@query(
    "fea04_leakage_check",
    f"select * from ({audit_oracle()}) a where post_as_of",
)
def _(t: Tables):
    return _audit(t).where("post_as_of")


@query(
    "fea06_targets",
    f"""select state, {', '.join(X.TARGET_COLUMNS)} from races
    where year = {YEAR} and office = 'president' and not special""",
    TARGETS,
)
def _(t: Tables):
    summary = L.stored_summary(t("election_results"))
    rows = L.regular_races(summary, "president").where(F.col("year") == YEAR)
    return rows.select("state", *X.TARGET_COLUMNS)


@query(
    "fea07_history_of_upcoming_races",
    f"""select * exclude (year, office, election_date) from (
    {history('before', 'house')}) h where year = {YEAR}""",
    HISTORY,
)
def _(t: Tables):
    summary = L.stored_summary(t("election_results"))
    races = X.race_universe("house", YEAR, summary, None, AS_OF)
    return X.history_before(summary, races, YEAR, "house", AS_OF)


@query(
    "fea08_turnout_before", "select * from turnout_before",
    "prev_turnout_registered prev_turnout_population prev_turnout_cvap prev_mail_vote_share prev_early_vote_share",
)
def _(t: Tables):
    return X.turnout_before(t("turnout"), t("population"), YEAR, AS_OF)


@query("fea09_naep_wide", "select * from scores")
def _(t: Tables):
    return X.naep_wide(t("naep"), AS_OF)


@query(
    "fea10_religion_latest", "select * from faith",
    "pct_catholic pct_evangelical_protestant pct_attend_weekly",
)
def _(t: Tables):
    return X.religion_latest(t("religion"), AS_OF)


@query(
    "fea11_usable_finance",
    f"""select candidate_id, coverage_end_date, retrieval_date, total_receipts from candidate_finance
    where cycle = {YEAR} and retrieval_date <= {T} and publication_date <= {T}""",
)
def _(t: Tables):
    return X.usable_finance(t("candidate_finance"), YEAR, AS_OF).select(
        "candidate_id", "coverage_end_date", "retrieval_date", "total_receipts"
    )


@query(
    "fea12_missingness",
    missing_shares("select * from polls") + " having missing > 0",
)
def _(t: Tables):
    return X.missingness(t("polls"))
