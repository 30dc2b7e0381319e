"""Check SQL: the operators' results stated independently, as common table
expressions over the derived tables, for an engine other than Spark."""

from __future__ import annotations

from ..functions.geo import STATES
from ..operators.economics import INDUSTRY_SHARE_CODES, STATE_MEASURES
from ..operators.elections import NON_CANDIDATE_LABELS
from .bridge import AS_OF, YEAR

T = f"date '{AS_OF}'"
RACE = "state, state_fips, year, office, district, special"
_LABELS = ", ".join(f"'{label}'" for label in NON_CANDIDATE_LABELS)


def newest(source: str, keys: str, order: str, where: str = "true") -> str:
    ordered = ", ".join(f"{c} desc nulls last" for c in order.split())
    return (
        f"select * exclude (rn) from (select *, row_number() over (partition by {keys} "
        f"order by {ordered}) as rn from {source} where {where}) z where rn = 1"
    )


def weighted(value: str, weight: str, cond: str) -> str:
    """Weighted mean of the rows meeting ``cond``, stated over filtered lists."""
    v, w = f"case when {cond} then {value} end", f"case when {cond} then {weight} end"
    mean = f"avg({v})"
    med = f"median({w})"
    stand = f"greatest(case when {med} is null or {med} = 0 then 1.0 else {med} end, 1.0)"
    clip = f"case when {w} is not null then greatest({w}, 1.0) end"
    none = f"(({cond}) and {weight} is null)"
    num = (
        f"coalesce(sum(({v}) * ({clip})), 0) + {mean} * coalesce(sum(case when {v} is null then {clip} end), 0)"
        f" + {stand} * (coalesce(sum(case when {none} then {value} end), 0)"
        f" + {mean} * count(*) filter (where {none} and {value} is null))"
    )
    den = f"coalesce(sum({clip}), 0) + {stand} * count(*) filter (where {none})"
    return (
        f"case when count({v}) = 0 then null when count({w}) = 0 then {mean} "
        f"else ({num}) / ({den}) end"
    )


def window(days: int, as_of: str = T, day: str = "end_date") -> str:
    return (
        f"({day} > {as_of} - {days} and {day} <= {as_of} and publication_date <= {as_of})"
    )


def history(source: str, office: str) -> str:
    seat = "partition by h.state, h.district order by h.year"
    senate = (
        "coalesce(max(case when p.year = h.year - 6 then p.year end), max(p.year))"
        if office == "senate"
        else "max(p.year)"
    )
    return f"""
select h.state, h.district, h.year, h.election_date, '{office}' as office,
  v.dem_two_party_share as prev_dem_share, v.dem_vote_share as prev_dem_vote_share,
  v.rep_vote_share as prev_rep_share, v.dem_rep_margin as prev_margin,
  v.winner_party as prev_winner_party, v.total_candidate_votes as prev_total_candidate_votes,
  v.year as prev_election_year,
  h.average_dem_share_last_2, h.average_dem_share_last_3, h.previous_swing,
  l.year as lean_year, l.state_partisan_lean, l.pres_dem_two_party_share,
  l.national_dem_two_party_share, l.weighted_state_lean
from (
  select h.*, avg(dem_two_party_share) over ({seat} rows between 2 preceding and 1 preceding) as average_dem_share_last_2,
    avg(dem_two_party_share) over ({seat} rows between 3 preceding and 1 preceding) as average_dem_share_last_3,
    lag(dem_two_party_share, 1) over ({seat}) - lag(dem_two_party_share, 2) over ({seat}) as previous_swing
  from {source} h where office = '{office}' and not special) h
left join (
  select h.state, h.district, h.year, {senate} as prev_year
  from {source} h join {source} p on p.state = h.state and p.district = h.district and p.office = h.office
    and not p.special and p.year < h.year
  where h.office = '{office}' and not h.special group by 1, 2, 3) k
  on k.state = h.state and k.district = h.district and k.year = h.year
left join {source} v on v.state = h.state and v.district = h.district and v.year = k.prev_year
  and v.office = '{office}' and not v.special
left join (
  select h.state, h.year as race_year, max(l.year) as lean_year
  from (select distinct state, year from {source} where office = '{office}' and not special) h
  join lean_{source} l on l.state = h.state and l.year < h.year group by 1, 2) y
  on y.state = h.state and y.race_year = h.year
left join lean_{source} l on l.state = h.state and l.year = y.lean_year"""


def lean(source: str) -> str:
    return f"""
select *, (0.6 * coalesce(l1, 0) + 0.3 * coalesce(l2, 0) + 0.1 * coalesce(l3, 0))
  / nullif(case when l1 is null then 0 else 0.6 end + case when l2 is null then 0 else 0.3 end
    + case when l3 is null then 0 else 0.1 end, 0) as weighted_state_lean
from (
  select state, s.year, dem_two_party_share as pres_dem_two_party_share,
    n.share as national_dem_two_party_share, dem_two_party_share - n.share as state_partisan_lean,
    election_date, publication_date, dem_two_party_share - n.share as l1,
    lag(dem_two_party_share - n.share, 1) over (partition by state order by s.year) as l2,
    lag(dem_two_party_share - n.share, 2) over (partition by state order by s.year) as l3
  from {source} s left join (
    select year, sum(dem_votes) / nullif(sum(dem_votes) + sum(rep_votes), 0) as share
    from {source} where office = 'president' and not special group by year) n on n.year = s.year
  where office = 'president' and not special) x"""


def finance(office: str, key: str) -> str:
    def best(party: str, column: str) -> str:
        return (
            f"max(case when party = '{party}' and place = 1 then {column} end)"
        )

    money = {
        "receipts": "total_receipts", "disbursements": "total_disbursements",
        "cash_on_hand": "cash_on_hand_end", "individual_contributions": "individual_contributions",
    }
    columns = ", ".join(
        f"coalesce({best(p.upper(), c)}, 0) as {p}_{n}" for n, c in money.items() for p in ("dem", "rep")
    )
    return f"""
select {key}, dem_receipts, rep_receipts, dem_disbursements, rep_disbursements, dem_cash_on_hand,
  rep_cash_on_hand, dem_individual_contributions, rep_individual_contributions,
  case when dem_receipts + rep_receipts > 0 then dem_receipts / (dem_receipts + rep_receipts) end as dem_fundraising_share,
  ln(1 + dem_receipts) as log_dem_receipts, ln(1 + rep_receipts) as log_rep_receipts,
  finance_coverage_end, finance_dem_candidate_id, finance_rep_candidate_id
from (
  select {key}, {columns}, max(coverage_end_date) as finance_coverage_end,
    {best('DEM', 'candidate_id')} as finance_dem_candidate_id,
    {best('REP', 'candidate_id')} as finance_rep_candidate_id
  from (
    select *, row_number() over (partition by {key}, party order by total_receipts desc, candidate_id) as place
    from (
      select *, row_number() over (partition by candidate_id order by coverage_end_date desc, revision_vintage desc) as rn
      from candidate_finance where office = '{office}' and cycle = {YEAR} and publication_date <= {T}
        and retrieval_date = (select max(retrieval_date) from candidate_finance
          where office = '{office}' and cycle = {YEAR} and retrieval_date <= {T})) a
    where rn = 1) b
  group by {key}) c"""


def held_then(table: str, keys: str, public: str) -> str:
    """Rows of the last retrieval by the day, per key; of the first one where there is none."""
    same = " and ".join(f"x.{k} = y.{k}" for k in keys.split(", "))
    among = f"from {table} x where {same} and {public}"
    return f"""
select * from {table} y where {public} and retrieval_date = coalesce(
  (select max(x.retrieval_date) {among} and x.retrieval_date <= {T}), (select min(x.retrieval_date) {among}))"""


def held_now(table: str, keys: str) -> str:
    return f"select * from {table} y where ({keys}, retrieval_date) in (select {keys}, max(retrieval_date) from {table} group by {keys})"


def incumbency(office: str, key: str) -> str:
    return f"""
select {key}, n_dem_candidates, n_rep_candidates, incumbent_party, open_seat,
  coalesce(incumbent_party = 'DEM', false) as dem_incumbent,
  coalesce(incumbent_party = 'REP', false) as rep_incumbent
from (
  select {key}, count(*) filter (where party = 'DEM') as n_dem_candidates,
    count(*) filter (where party = 'REP') as n_rep_candidates,
    case when count(*) filter (where incumbent_challenger_status = 'I' and party = 'DEM') > 0 then 'DEM'
      when count(*) filter (where incumbent_challenger_status = 'I' and party = 'REP') > 0 then 'REP'
      when count(*) filter (where incumbent_challenger_status = 'I') > 0 then 'OTHER' end as incumbent_party,
    count(*) filter (where incumbent_challenger_status = 'O') > 0
      and count(*) filter (where incumbent_challenger_status = 'I') = 0 as open_seat
  from candidates_then where office = '{office}' and cycle = {YEAR}
    and coalesce(election_year, {YEAR}) = {YEAR} and coalesce(candidate_status, 'C') in ('C', 'N')
  group by {key}) x"""


def race_polls(office: str, key: str) -> str:
    parts = {"margin": "poll_margin", "dem": "dem_pct", "rep": "rep_pct"}
    month = ", ".join(f"{weighted(c, 'sample_size', window(30))} as m_{n}" for n, c in parts.items())
    last = ", ".join(f"{weighted(c, 'sample_size', 'true')} as l_{n}" for n, c in parts.items())
    on = " and ".join(f"w.{k} = f.{k}" for k in key.split(", "))
    picks = ", ".join(
        f"case when number_recent_polls > 0 then m_{n} else l_{n} end as state_poll_{n}" for n in parts
    )
    kept = ", ".join(f"w.{k}" for k in key.split(", "))
    return f"""
select {kept}, {picks}, polling_average_7d, m_margin as polling_average_30d, number_recent_polls,
  polling_uncertainty, cast({T} - last_end as int) as poll_recency_days,
  cast(date '2000-11-07' - {T} as int) as days_to_election
from (
  select {key}, {month}, {weighted('poll_margin', 'sample_size', window(7))} as polling_average_7d,
    count(*) filter (where {window(30)}) as number_recent_polls,
    case when count(*) filter (where {window(30)}) > 1
      then stddev_samp(case when {window(30)} then poll_margin end) end as polling_uncertainty,
    max(end_date) as last_end
  from polls where year = {YEAR} and office = '{office}' and publication_date <= {T} group by {key}) w
left join (
  select {key}, {last} from (
    select *, row_number() over (partition by {key} order by end_date desc, publication_date desc, poll_id desc) as rn
    from polls where year = {YEAR} and office = '{office}' and publication_date <= {T}) x
  where rn <= 3 group by {key}) f on {on}"""


_SHARES = ",\n".join(
    f"  sum(case when own_code = '5' and industry_code = '{code}' then annual_avg_employment end) "
    f"/ nullif(max(case when industry_code = '10' and own_code = '0' then annual_avg_employment end), 0) as {name}"
    for code, name in INDUSTRY_SHARE_CODES.items()
)
_MEASURES = ", ".join(f"max(case when measure = '{m}' then value end) as {m}" for m in STATE_MEASURES)
_GROWN = (
    "real_gdp", "nominal_gdp", "personal_income", "real_personal_income",
    "per_capita_personal_income",
)
_GROWTH = ", ".join(
    f"{m} / nullif(lag({m}) over (partition by state order by year), 0) - 1 as {m}_growth" for m in _GROWN
)


def months_back(value: str, k: int) -> str:
    return (
        f"max({value}) over (partition by state order by year(date) * 12 + month(date) "
        f"range between {k} preceding and {k} preceding)"
    )


def national_series(name: str, measure: str, adjusted: str) -> str:
    return f"""
select '{name}' as series, date, max(value) as value from national_then
where publication_date <= {T} and measure = '{measure}' and (seasonally_adjusted = {adjusted}
  or not exists (select 1 from national_then x where x.publication_date <= {T}
    and x.measure = '{measure}' and x.seasonally_adjusted = {adjusted})) group by date"""


def change(name: str, months: int) -> str:
    """Newest month over the month exactly that much earlier, minus one."""
    return (
        f"(select a.value / b.value - 1 from national_series a join national_series b "
        f"on b.series = a.series and b.date = a.date - interval {months} month "
        f"where a.series = '{name}' and a.date = (select max(date) from national_series where series = '{name}'))"
    )


def level(name: str) -> str:
    return (
        f"(select value from national_series where series = '{name}' "
        f"and date = (select max(date) from national_series where series = '{name}'))"
    )


CTES: dict[str, str] = {
    "lines": f"""
select * from election_results where coalesce(election_type, 'general') = 'general'
  and upper(coalesce(candidate, '')) not in ({_LABELS})""",
    "summary": f"""
select {RACE}, min(election_date) as election_date, max(total_votes) as total_votes,
  count(distinct candidate) as n_candidates,
  sum(case when party = 'DEM' then votes else 0 end) as dem_votes,
  sum(case when party = 'REP' then votes else 0 end) as rep_votes,
  sum(case when party in ('DEM', 'REP') then 0 else votes end) as other_votes,
  sum(votes) as total_candidate_votes,
  sum(case when party = 'DEM' then votes else 0 end) / nullif(sum(votes), 0) as dem_vote_share,
  sum(case when party = 'REP' then votes else 0 end) / nullif(sum(votes), 0) as rep_vote_share,
  sum(case when party in ('DEM', 'REP') then 0 else votes end) / nullif(sum(votes), 0) as other_vote_share,
  sum(case when party = 'DEM' then votes end) / nullif(sum(case when party in ('DEM', 'REP') then votes end), 0) as d2,
  sum(case when party = 'REP' then votes end) / nullif(sum(case when party in ('DEM', 'REP') then votes end), 0) as r2,
  case when sum(case when party in ('DEM', 'REP') then votes end) > 0 then coalesce(d2, 0) end as dem_two_party_share,
  case when sum(case when party in ('DEM', 'REP') then votes end) > 0 then coalesce(r2, 0) end as rep_two_party_share,
  case when sum(case when party in ('DEM', 'REP') then votes end) > 0 then coalesce(d2, 0) - coalesce(r2, 0) end as dem_rep_margin,
  max(case when place = 1 then party end) as winner_party,
  (max(case when place = 1 then votes end) - coalesce(max(case when place = 2 then votes end), 0))
    / nullif(sum(votes), 0) as winning_margin,
  max(case when party = 'DEM' and party_place = 1 then candidate end) as dem_candidate,
  max(case when party = 'REP' and party_place = 1 then candidate end) as rep_candidate,
  sum(case when party = 'DEM' then votes else 0 end) <= 0
    or sum(case when party = 'REP' then votes else 0 end) <= 0 as uncontested,
  max(publication_date) as publication_date, max(publication_date_estimated) as publication_date_estimated,
  max(retrieval_date) as retrieval_date, max(revision_vintage) as revision_vintage, min(source) as source,
  min(dataset_id) as dataset_id, min(ingestion_run_id) as ingestion_run_id,
  min(election_date) as observation_date, min(election_date) as period_start, min(election_date) as period_end
from (
  select *, row_number() over (partition by {RACE} order by votes desc, candidate, party) as place,
    row_number() over (partition by {RACE}, party order by votes desc, candidate) as party_place
  from lines) r group by {RACE}""",
    "races": "select * exclude (d2, r2) from summary",
    "lean_races": lean("races"),
    # Races known before the target year plus a row without outcome per target race.
    "before": f"""
select * from races where publication_date <= {T} and year < {YEAR}
union all by name
select distinct state, district, year, office, false as special from races
where year = {YEAR} and not special""",
    "lean_before": lean("before"),
    "people": newest(
        f"(select *, try_cast(revision_vintage as double) as v from population where publication_date <= {T}) p",
        "state, year", "v",
    ),
    "people_any": newest(
        "(select *, try_cast(revision_vintage as double) as v from population) p", "state, year", "v"
    ),
    "population_growth": """
select state, population_year, population, population_growth_1y, population_growth_4y,
  population_growth_10y, domestic_migration, international_migration, net_migration,
  domestic_migration_rate, net_migration_rate, population_publication_date, population_vintage
from (
  select state, year as population_year, population,
    population / nullif(lag(population, 1) over (partition by state order by year), 0) - 1 as population_growth_1y,
    population / nullif(lag(population, 4) over (partition by state order by year), 0) - 1 as population_growth_4y,
    population / nullif(lag(population, 10) over (partition by state order by year), 0) - 1 as population_growth_10y,
    domestic_migration, international_migration, net_migration, domestic_migration_rate, net_migration_rate,
    publication_date as population_publication_date, revision_vintage as population_vintage,
    row_number() over (partition by state order by year desc) as rn
  from people) x where rn = 1""",
    "density": f"""
select p.*, g.land_area_sq_miles, p.population / nullif(g.land_area_sq_miles, 0) as population_density,
  ln(1 + p.population / nullif(g.land_area_sq_miles, 0)) as log_population_density
from population_growth p left join ({newest('geography', 'state', 'year publication_date revision_vintage', f'publication_date <= {T}')}) g on g.state = p.state""",
    "acs": f"""
select state, year as acs_year, publication_date as acs_publication_date, median_age, pct_bachelors,
  median_household_income, poverty_rate, total_population as acs_total_population
from ({newest('demographics', 'state', 'year publication_date revision_vintage', f"publication_date <= {T} and survey = 'acs1'")}) a""",
    "urban": f"""
select state, pct_urban, pct_rural, year as urban_rural_census_year
from ({newest('urban_rural', 'state', 'year publication_date revision_vintage', f'publication_date <= {T}')}) u""",
    "metrics": """
select t.*, t.ballots_cast / nullif(t.registered_voters, 0) as turnout_registered,
  t.ballots_cast / nullif(t.citizen_voting_age_population, 0) as turnout_cvap,
  t.registered_voters / nullif(t.citizen_voting_age_population, 0) as registration_rate,
  p.population, t.ballots_cast / nullif(p.population, 0) as turnout_population,
  t.mail_votes / nullif(t.ballots_cast, 0) as mail_vote_share,
  t.early_votes / nullif(t.ballots_cast, 0) as early_vote_share
from turnout t left join people_any p on p.state = t.state and p.year = t.year""",
    "turnout_before": f"""
select state, year as prev_turnout_year, turnout_registered as prev_turnout_registered,
  registered_voters as prev_registered_voters, ballots_cast as prev_ballots_cast,
  turnout_population as prev_turnout_population, turnout_cvap as prev_turnout_cvap,
  mail_vote_share as prev_mail_vote_share, early_vote_share as prev_early_vote_share
from (
  select t.*, t.ballots_cast / nullif(t.registered_voters, 0) as turnout_registered,
    t.ballots_cast / nullif(t.citizen_voting_age_population, 0) as turnout_cvap,
    t.ballots_cast / nullif(p.population, 0) as turnout_population,
    t.mail_votes / nullif(t.ballots_cast, 0) as mail_vote_share,
    t.early_votes / nullif(t.ballots_cast, 0) as early_vote_share,
    row_number() over (partition by t.state order by t.year desc) as rn
  from turnout t left join people p on p.state = t.state and p.year = t.year
  where t.publication_date <= {T} and t.year < {YEAR} and t.year % 4 = 0) x where rn = 1""",
    "labor_then": held_then("labor", "state, date, seasonally_adjusted", f"publication_date <= {T}"),
    "national_then": held_then(
        "national_economy", "measure, seasonally_adjusted, date, series_id", f"publication_date <= {T}"
    ),
    "national_now": held_now("national_economy", "measure, seasonally_adjusted, date, series_id"),
    "candidates_then": held_then(
        "candidates", "candidate_id, cycle", f"(publication_date <= {T} or publication_date is null)"
    ),
    "candidates_now": held_now("candidates", "candidate_id, cycle"),
    "jobs": f"""
select state, date as labor_month, unemployment_rate, unemployment_rate_3m_avg, unemployment_rate_12m_avg,
  unemployment_change_3m, unemployment_change_12m, employment_growth_12m, labor_force_growth_12m,
  labor_publication_date
from (
  select *, case when count(*) over m3 >= 3 then avg(unemployment_rate) over m3 end as unemployment_rate_3m_avg,
    case when count(*) over m12 >= 12 then avg(unemployment_rate) over m12 end as unemployment_rate_12m_avg,
    unemployment_rate - {months_back('unemployment_rate', 3)} as unemployment_change_3m,
    unemployment_rate - {months_back('unemployment_rate', 12)} as unemployment_change_12m,
    employment / nullif({months_back('employment', 12)}, 0) - 1 as employment_growth_12m,
    labor_force / nullif({months_back('labor_force', 12)}, 0) - 1 as labor_force_growth_12m,
    max(publication_date) over (partition by state) as labor_publication_date,
    row_number() over (partition by state order by date desc) as rn
  from labor_then where seasonally_adjusted
  window m3 as (partition by state order by date rows between 2 preceding and current row),
    m12 as (partition by state order by date rows between 11 preceding and current row)) x
where rn = 1""",
    "industry_mix": f"""
select state, max(year) as industry_year,
  max(case when industry_code = '10' and own_code = '0' then annual_avg_employment end) as total_employment,
  max(case when industry_code = '10' and own_code = '0' then annual_avg_weekly_wage end) as average_weekly_wage,
  max(case when industry_code = '10' and own_code = '0' then avg_annual_pay end) as avg_annual_pay,
{_SHARES},
  sum(case when industry_code = '10' and own_code in ('1', '2', '3') then annual_avg_employment end)
    / nullif(max(case when industry_code = '10' and own_code = '0' then annual_avg_employment end), 0) as pct_government
from industry where publication_date <= {T}
  and year = (select max(year) from industry where publication_date <= {T})
group by state having count(*) filter (where industry_code = '10' and own_code = '0') > 0""",
    "accounts": f"""
select * exclude (rn), real_gdp / nullif(population, 0) as real_gdp_per_capita from (
  select state, year as state_economy_year, {', '.join(STATE_MEASURES)}, {_GROWTH},
    row_number() over (partition by state order by year desc) as rn
  from (select state, year, {_MEASURES} from state_economy where publication_date <= {T} group by 1, 2) w) x
where rn = 1""",
    "national_series": " union all ".join(
        national_series(name, measure, adjusted)
        for name, measure, adjusted in (
            ("ur", "unemployment_rate", "true"),
            ("lfpr", "labor_force_participation_rate", "true"),
            ("cpi", "cpi_all_items", "false"),
            ("cpi_sa", "cpi_all_items", "true"),
            ("core", "cpi_core", "false"),
            ("pay", "nonfarm_payrolls", "true"),
            ("ahe", "average_hourly_earnings", "true"),
        )
    ),
    "national_row": f"""
select *, (1 + wage_growth_12m) / (1 + cpi_yoy) - 1 as real_wage_growth_12m,
  (select cast(max(date) as varchar) from national_economy where publication_date <= {T}) as national_data_month
from (
  select {level('ur')} as national_unemployment_rate,
    (select a.value - b.value from national_series a join national_series b on b.series = a.series
      and b.date = a.date - interval 12 month where a.series = 'ur'
      and a.date = (select max(date) from national_series where series = 'ur')) as national_unemployment_change_12m,
    {level('lfpr')} as national_labor_force_participation, {change('cpi', 12)} as cpi_yoy,
    {change('cpi_sa', 1)} as cpi_mom, pow({change('cpi_sa', 3)} + 1, 4) - 1 as cpi_3m_annualized,
    {change('core', 12)} as core_cpi_yoy, {level('pay')} as nonfarm_payrolls,
    {change('pay', 1)} as payroll_growth_1m, {change('pay', 3)} as payroll_growth_3m,
    {change('pay', 12)} as payroll_growth_12m, {change('ahe', 12)} as wage_growth_12m) x""",
    "incumbency_president": incumbency("president", "state"),
    "incumbency_senate": incumbency("senate", "state"),
    "incumbency_house": incumbency("house", "state, district"),
    "finance_president": finance("president", "state"),
    "finance_senate": finance("senate", "state"),
    "finance_house": finance("house", "state, district"),
    "race_polls_president": race_polls("president", "state"),
    "race_polls_senate": race_polls("senate", "state"),
    "race_polls_house": race_polls("house", "state, district"),
    "approval": "select {}, approval_average_30d - prev as approval_change_30d, n_approval_polls_30d from (select {}, {} as prev, count(*) filter (where {}) as n_approval_polls_30d from approval_polls where publication_date <= {}) x".format(
        ", ".join(f"approval_average_{d}d, net_approval_{d}d" for d in (7, 30, 90)),
        ", ".join(
            f"{weighted('approve', 'sample_size', window(d))} as approval_average_{d}d, "
            f"{weighted('net_approval', 'sample_size', window(d))} as net_approval_{d}d"
            for d in (7, 30, 90)
        ),
        weighted("approve", "sample_size", window(30, f"({T} - 30)")), window(30), T,
    ),
    "generic": "select {}, generic_ballot_dem_30d, generic_ballot_rep_30d, generic_margin_30d - prev as generic_change_30d, n_generic_polls_30d from (select {}, {} as generic_ballot_dem_30d, {} as generic_ballot_rep_30d, {} as prev, count(*) filter (where {}) as n_generic_polls_30d from generic_ballot_polls where publication_date <= {}) x".format(
        ", ".join(f"generic_margin_{d}d" for d in (7, 30, 90)),
        ", ".join(
            f"{weighted('generic_margin', 'sample_size', window(d))} as generic_margin_{d}d"
            for d in (7, 30, 90)
        ),
        weighted("generic_dem", "sample_size", window(30)),
        weighted("generic_rep", "sample_size", window(30)),
        weighted("generic_margin", "sample_size", window(30, f"({T} - 30)")), window(30), T,
    ),
    "swings": "select {} from special_elections where publication_date <= {}".format(
        ", ".join(
            f"avg(case when {window(d, day='election_date')} then special_election_swing end) as special_election_swing_{d}d"
            for d in (30, 90, 180)
        ),
        T,
    ),
    "scores": f"""
select state, max(case when subject = 'mathematics' and grade = 4 then average_score end) as naep_math_grade4,
  max(case when subject = 'mathematics' and grade = 8 then average_score end) as naep_math_grade8,
  max(case when subject = 'reading' and grade = 4 then average_score end) as naep_read_grade4,
  max(case when subject = 'reading' and grade = 8 then average_score end) as naep_read_grade8,
  max(assessment_year) as naep_year
from ({newest('naep', 'state, grade, subject', 'assessment_year publication_date', f'publication_date <= {T}')}) n
group by state""",
    "faith": f"""
select state, survey_year as religion_survey_year, pct_catholic, pct_evangelical_protestant, pct_attend_weekly
from ({newest('religion', 'state', 'survey_year publication_date', f'publication_date <= {T}')}) r""",
    "state_names": "select * from (values {}) v(state_name, state, state_fips, census_region, census_division, is_state)".format(
        ", ".join(
            "(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v).lower() for v in row) + ")"
            for row in STATES
        )
    ),
}
