"""Queries through the query interface: SQL, table reads and the subjects."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..api.platform import Platform, apply_filters, known_broken, status_frame
from ..errors import DatasetUnavailableError
from ..operators.pit import snapshot_as_of
from ..sources import registry as G
from ..storage import manifest as M
from ..storage.lake import run_query, select_from
from . import bridge
from .bridge import AS_OF, YEAR
from .checks import T, history, newest
from .core import (
    APPROVAL,
    FEATURE_RATIOS,
    FEATURE_TABLES,
    GENERIC,
    GROWTH,
    HISTORY,
    JOBS,
    LEAN,
    MIX,
    MONEY,
    NATION,
    RACE_POLLS,
    SHARES,
    TURNOUT,
    audit_oracle,
    features_oracle,
)
from .registry import Tables, query


def _platform(t: Tables) -> Platform:
    """The subjects over tables derived on demand."""

    def read(name: str):
        if name not in bridge.SQL:
            raise DatasetUnavailableError(f"{name!r} is not derived")
        return t(name)

    return Platform(read)


@query(
    "api01_sql_named_parameters",
    "select office, count(*) as lines, sum(votes) as votes from election_results where year >= 1997 and party = 'DEM' group by 1",
)
def _(t: Tables):
    t("election_results").createOrReplaceTempView("election_results_view")
    sql = (
        "select office, count(*) as lines, sum(votes) as votes from election_results_view "
        "where year >= :first and party = :party group by 1"
    )
    return run_query(t.spark, sql, {"first": 1997, "party": "DEM"})


@query(
    "api01_sql_positional_parameters",
    "select state, max(unemployment_rate) as top from labor where seasonally_adjusted and date >= date '1999-01-01' group by 1",
    "top",
)
def _(t: Tables):
    t("labor").createOrReplaceTempView("labor_view")
    sql = (
        "select state, max(unemployment_rate) as top from labor_view "
        "where seasonally_adjusted and date >= cast(? as date) group by 1"
    )
    return run_query(t.spark, sql, ["1999-01-01"])


@query(
    "api02_query_table",
    "select state, year, votes from election_results where office = 'senate' and state in ('AL', 'AK', 'TX') and year in (1996, 2000)",
)
def _(t: Tables):
    filters = {"office": "senate", "state": ["AL", "AK", "TX"], "year": (1996, 2000), "district": None}
    return select_from(
        t("election_results"), filters, columns=["state", "year", "votes"],
        order_by=["state", "year"],
    )


@query("api02_query_table_empty_list", "select state, year from turnout where 1 = 0")
def _(t: Tables):
    return select_from(t("turnout"), {"state": []}, columns=["state", "year"])


@query("api03_apply_filters", "select state, year, ballots_cast from turnout where year = 1998")
def _(t: Tables):
    rows = apply_filters(t("turnout"), year=1998, no_such_column="x", state=None)
    return rows.select("state", "year", "ballots_cast")


@query("api04_as_of_filter", f"select state, year from turnout where publication_date <= {T}")
def _(t: Tables):
    return _platform(t).elections.turnout(as_of=AS_OF, with_metrics=False).select("state", "year")


@query(
    "api05_latest_vintage",
    f"select candidate_id, cycle, coverage_end_date, total_receipts from ({newest('candidate_finance', 'candidate_id, cycle, coverage_end_date', 'retrieval_date revision_vintage')}) x",
)
def _(t: Tables):
    keys = ["candidate_id", "cycle", "coverage_end_date"]
    rows = t("candidate_finance")
    return snapshot_as_of(rows, None, keys, then=["revision_vintage"]).select(*keys, "total_receipts")


@query(
    "api08_results_by_race",
    "select * from races where year in (1996, 2000) and office = 'house' and state in ('AL', 'CA') and not special",
    SHARES,
)
def _(t: Tables):
    return _platform(t).elections.results([1996, 2000], "US House", ["Alabama", "06"])


@query(
    "api08_results_by_candidate",
    f"select state, year, district, candidate, party, votes from election_results where office = 'senate' and publication_date <= {T}",
)
def _(t: Tables):
    rows = _platform(t).elections.results(
        office="sen", level="candidate", include_special=True, as_of=AS_OF
    )
    return rows.select("state", "year", "district", "candidate", "party", "votes")


@query("api09_turnout", "select * from metrics where state = 'CA' and year = 2000", TURNOUT)
def _(t: Tables):
    return _platform(t).elections.turnout(2000, "California")


@query(
    "api10_partisan_lean", "select * exclude (l1, l2, l3) from lean_races where state = 'GA'", LEAN
)
def _(t: Tables):
    return _platform(t).elections.partisan_lean("GA")


@query(
    "api11_history", f"select * from ({history('races', 'senate')}) h where state in ('GA', 'HI')",
    HISTORY,
)
def _(t: Tables):
    return _platform(t).elections.history("senate", ["GA", "HI"])


@query(
    "api12_demographics_state",
    f"select state, year, survey, median_age from demographics where survey = 'acs5' and state = 'FL' and publication_date <= {T}",
)
def _(t: Tables):
    rows = _platform(t).demographics.state("FL", survey="acs5", as_of=AS_OF)
    return rows.select("state", "year", "survey", "median_age")


@query(
    "api13_population_newest",
    "select state, year, population, revision_vintage from people where state = 'AZ'",
)
def _(t: Tables):
    rows = _platform(t).demographics.population("AZ", as_of=AS_OF)
    return rows.select("state", "year", "population", "revision_vintage")


@query(
    "api13_population_vintage",
    "select state, year, population from population where revision_vintage = '1998' and year = 1997",
)
def _(t: Tables):
    rows = _platform(t).demographics.population(year=1997, vintage=1998)
    return rows.select("state", "year", "population")


@query("api14_geography", "select state, year, land_area_sq_miles from geography where state = 'IA'")
def _(t: Tables):
    return _platform(t).demographics.geography("Iowa").select("state", "year", "land_area_sq_miles")


@query(
    "api15_urban_rural",
    f"select state, year, pct_urban from urban_rural where publication_date <= {T}", "pct_urban",
)
def _(t: Tables):
    return _platform(t).demographics.urban_rural(as_of=AS_OF).select("state", "year", "pct_urban")


@query(
    "api16_snapshot",
    "select * from acs full outer join density using (state) full outer join urban using (state)",
    GROWTH + " pct_bachelors poverty_rate population_density log_population_density pct_urban pct_rural",
)
def _(t: Tables):
    return _platform(t).demographics.snapshot(AS_OF)


@query(
    "api17_labor",
    f"select state, date, employment from labor_then where seasonally_adjusted and date between date '1997-01-01' and date '1999-12-01' and state = 'DE'",
)
def _(t: Tables):
    rows = _platform(t).economics.labor("DE", start="1997-01-01", end="1999-12-01", as_of=AS_OF)
    return rows.select("state", "date", "employment")


@query("api18_labor_snapshot", "select * from jobs where state in ('ME', 'MI')", JOBS)
def _(t: Tables):
    return _platform(t).economics.labor_snapshot(AS_OF, ["ME", "MI"])


@query(
    "api19_industry",
    "select state, industry_code, own_code, annual_avg_employment from industry where year = 1997",
)
def _(t: Tables):
    rows = _platform(t).economics.industry(year=1997)
    return rows.select("state", "industry_code", "own_code", "annual_avg_employment")


@query("api19_industry_shares", "select * from industry_mix where state = 'ID'", MIX)
def _(t: Tables):
    return _platform(t).economics.industry("ID", as_of=AS_OF, shares=True)


@query(
    "api20_state_economy",
    f"select state, year, measure, value from state_economy where measure in ('real_gdp', 'population') and publication_date <= {T}",
)
def _(t: Tables):
    rows = _platform(t).economics.state_economy(measure=["real_gdp", "population"], as_of=AS_OF)
    return rows.select("state", "year", "measure", "value")


_WIDE = ", ".join(
    f"max(case when measure = '{m}' and {'not ' if tag == 'nsa' else ''}seasonally_adjusted then value end) as {m}_{tag}"
    for m in (
        "unemployment_rate", "cpi_all_items", "cpi_core",
        "nonfarm_payrolls", "average_hourly_earnings",
    )
    for tag in ("sa", "nsa")
)


@query("api21_national_wide", f"select date, {_WIDE} from national_then group by 1")
def _(t: Tables):
    return _platform(t).economics.national(as_of=AS_OF, wide=True)


@query(
    "api21_national_long",
    "select measure, date, seasonally_adjusted, value from national_now where measure = 'cpi_core'",
)
def _(t: Tables):
    rows = _platform(t).economics.national(measure="cpi_core")
    return rows.select("measure", "date", "seasonally_adjusted", "value")


@query("api22_national_snapshot", "select * from national_row", NATION)
def _(t: Tables):
    return _platform(t).economics.national_snapshot(AS_OF)


@query(
    "api23_candidates",
    "select candidate_id, cycle, party from candidates_now where cycle = 2000 and office = 'senate' and candidate_status in ('C', 'N')",
)
def _(t: Tables):
    rows = _platform(t).candidates.candidates(2000, office="senate")
    return rows.select("candidate_id", "cycle", "party")


@query("api24_incumbency", "select * from incumbency_house")
def _(t: Tables):
    return _platform(t).candidates.incumbency(YEAR, "house", as_of=AS_OF)


@query(
    "api25_finance_rows",
    f"select candidate_id, state, coverage_end_date, total_receipts from candidate_finance where cycle = 1998 and publication_date <= {T}",
)
def _(t: Tables):
    rows = _platform(t).candidates.finance(year=1998, as_of=AS_OF)
    return rows.select("candidate_id", "state", "coverage_end_date", "total_receipts")


@query("api25_finance_by_race", "select * from finance_senate where state = 'GA'", MONEY)
def _(t: Tables):
    return _platform(t).candidates.finance("GA", YEAR, "senate", as_of=AS_OF, race_level=True)


@query(
    "api26_race_polls",
    f"select poll_id, state, end_date, poll_margin from polls where office = 'senate' and year = 2000 and state = 'AZ' and publication_date <= {T}",
    "poll_margin",
)
def _(t: Tables):
    rows = _platform(t).polls.races(2000, "AZ", "senate", as_of=AS_OF)
    return rows.select("poll_id", "state", "end_date", "poll_margin")


@query(
    "api26_race_poll_averages",
    "select * replace (cast(null as int) as days_to_election) from race_polls_senate where state in ('AL', 'AR')",
    RACE_POLLS,
)
def _(t: Tables):
    return _platform(t).polls.races(2000, ["AL", "AR"], "senate", as_of=AS_OF, aggregate=True)


@query(
    "api27_approval",
    f"select poll_id, end_date, approve from approval_polls where publication_date <= {T}",
)
def _(t: Tables):
    return _platform(t).polls.approval(as_of=AS_OF).select("poll_id", "end_date", "approve")


@query("api27_approval_averages", "select * from approval", APPROVAL)
def _(t: Tables):
    return _platform(t).polls.approval(as_of=AS_OF, aggregate=True)


@query("api28_generic_ballot_averages", "select * from generic", GENERIC)
def _(t: Tables):
    return _platform(t).polls.generic_ballot(as_of=AS_OF, aggregate=True)


@query(
    "api29_special_elections",
    f"select state, district, election_date, special_election_swing from special_elections where publication_date <= {T}",
    "special_election_swing",
)
def _(t: Tables):
    rows = _platform(t).polls.special_elections(as_of=AS_OF)
    return rows.select("state", "district", "election_date", "special_election_swing")


@query(
    "api31_runs",
    "select run_id, dataset, started_at, status from ingestion_runs order by started_at desc, run_id desc limit 50",
)
def _(t: Tables):
    return M.runs(t("ingestion_runs"), limit=50).select("run_id", "dataset", "started_at", "status")


@query(
    "api31_failed_runs",
    "select run_id, dataset, error from ingestion_runs where status = 'failed' order by started_at desc, run_id desc limit 20",
)
def _(t: Tables):
    return M.failed_runs(t("ingestion_runs"), 20).select("run_id", "dataset", "error")


@query(
    "api32_last_success",
    "select run_id, completed_at from ingestion_runs where dataset = 'bls-laus' and status = 'success' order by completed_at desc, run_id desc limit 1",
)
def _(t: Tables):
    return M.last_success(t("ingestion_runs"), "bls-laus").select("run_id", "completed_at")


@query(
    "api32_last_run",
    "select run_id, status from ingestion_runs where dataset = 'naep-state' order by started_at desc, run_id desc limit 1",
)
def _(t: Tables):
    return M.last_run(t("ingestion_runs"), "naep-state").select("run_id", "status")


_LATEST = """select l.dataset, l.status as last_status, l.started_at as last_run, l.error as last_error,
  s.completed_at as last_success, s.row_count as last_row_count
  from (select *, row_number() over (partition by dataset order by started_at desc, run_id desc) as rn from ingestion_runs) l
  left join (select *, row_number() over (partition by dataset order by started_at desc, run_id desc) as rn from ingestion_runs
    where status = 'success') s on s.dataset = l.dataset and s.rn = 1 where l.rn = 1"""


@query("api33_latest_by_dataset", _LATEST)
def _(t: Tables):
    return M.latest_by_dataset(t("ingestion_runs"))


@query(
    "api34_run_metadata",
    "select run_id, dataset, status, error, row_count from ingestion_runs where run_id = 'run-000000000007'",
)
def _(t: Tables):
    rows = M.run_metadata(t("ingestion_runs"), "run-000000000007")
    return rows.select("run_id", "dataset", "status", "error", "row_count")


_SPECS = ", ".join(
    f"('{s.id}', '{s.table}', {s.phase}, '{s.status}', {str(s.has_connector).lower()})"
    for s in G.REGISTRY.values()
)
_REGISTRY = f"(select * from (values {_SPECS}) v(id, \"table\", phase, status, has_connector))"


@query(
    "api35_sources_with_runs",
    f"""select g.id, g."table", g.phase, g.status, count(r.run_id) as runs from {_REGISTRY} g
    left join ingestion_runs r on r.dataset = g.id group by 1, 2, 3, 4""",
)
def _(t: Tables):
    runs = t("ingestion_runs").groupBy(F.col("dataset").alias("id")).agg(
        F.count(F.lit(1)).alias("runs")
    )
    return G.sources(t.spark).join(runs, "id", "left").select(
        "id", "table", "phase", "status", F.coalesce("runs", F.lit(0)).alias("runs")
    )


@query(
    "api35_list_specs_with_runs",
    f"""select g.id, count(r.run_id) as runs from {_REGISTRY} g left join ingestion_runs r on r.dataset = g.id
    where g.phase = 3 and g.has_connector group by 1""",
)
def _(t: Tables):
    specs = G.list_specs(t.spark, phase="economics", runnable_only=True)
    runs = t("ingestion_runs").select(F.col("dataset").alias("id"), "run_id")
    return specs.join(runs, "id", "left").groupBy("id").agg(F.count("run_id").alias("runs"))


@query(
    "api35_status_counts",
    f"""select s.status, count(distinct g.id) as datasets, count(distinct r.dataset) as datasets_run, count(r.run_id) as runs,
    count(r.run_id) filter (where r.status = 'failed') as failed_runs
    from (select unnest([{", ".join(f"'{s}'" for s in G.STATUSES)}]) as status) s
    left join {_REGISTRY} g on g.status = s.status left join ingestion_runs r on r.dataset = g.id group by 1""",
)
def _(t: Tables):
    return G.status_counts(t.spark, t("ingestion_runs"))


def _status(t: Tables):
    inventory = t("population").groupBy("dataset_id").agg(
        F.count(F.lit(1)).alias("rows")
    ).unionByName(t("naep").groupBy("dataset_id").agg(F.count(F.lit(1)).alias("rows")))
    return status_frame(t("ingestion_runs"), inventory)


_STATUS = f"""select g.id as dataset_id, g.status, x.last_status as last_run_status, x.last_run, x.last_success, i.rows
  from {_REGISTRY} g left join ({_LATEST}) x on x.dataset = g.id
  left join (select dataset_id, count(*) as rows from population group by 1 union all
    select dataset_id, count(*) from naep group by 1) i on i.dataset_id = g.id"""


@query("api36_status_frame", _STATUS)
def _(t: Tables):
    return _status(t).select(
        "dataset_id", "status", "last_run_status", "last_run", "last_success", "rows"
    )


@query(
    "api37_known_broken",
    f"select dataset_id from ({_STATUS}) s where last_run_status = 'failed' and status in ('DONE', 'PARTIAL')",
)
def _(t: Tables):
    return known_broken(_status(t))


@query("api30_features_audit", audit_oracle())
def _(t: Tables):
    return Platform.of_tables(t.many(FEATURE_TABLES)).features.audit(YEAR, "senate", AS_OF)


@query("api30_features_build", features_oracle("house"), FEATURE_RATIOS)
def _(t: Tables):
    return Platform.of_tables(t.many(FEATURE_TABLES)).features.build(YEAR, "house", AS_OF).frame
