"""Queries behind the election explorer."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import elections as L
from ..operators import explorer as X
from .registry import Tables, query

_SHARES = """(select state, year, office, d / (d + r) as share from (
  select state, year, office, sum(dem_votes) as d, sum(rep_votes) as r from races where not special group by 1, 2, 3) x
  where d + r > 0)"""
_BALLOTS = """(select t.state, t.year, t.ballots_cast as ballots, p.population from turnout t
  left join people_any p on p.state = t.state and p.year = t.year)"""


def _shares(t: Tables):
    return X.election_shares(L.stored_summary(t("election_results")))


def _ballots(t: Tables):
    from ..operators.turnout import newest_vintage_per_year

    people = newest_vintage_per_year(t("population"), ["population"])
    votes = t("turnout").select("state", "year", F.col("ballots_cast").alias("ballots"))
    return votes.join(people, ["state", "year"], "left")


@query("exp01_valid_years", f"select distinct year from {_SHARES} s where year % 4 = 0")
def _(t: Tables):
    return X.valid_years(_shares(t), "president")


@query(
    "exp02_swing_house",
    f"""select a.state, a.year, a.office, a.share, b.share as previous_share, a.share - b.share as swing
    from {_SHARES} a left join {_SHARES} b on b.state = a.state and b.office = a.office and b.year = a.year - 2
    where a.office = 'house'""",
    "share previous_share swing",
)
def _(t: Tables):
    return X.with_previous(_shares(t), "house")


@query(
    "exp02_swing_senate",
    f"""select a.state, a.year, a.office, a.share, b.share as previous_share, a.share - b.share as swing
    from {_SHARES} a left join {_SHARES} b on b.state = a.state and b.office = a.office and b.year = a.year - 6
    where a.office = 'senate'""",
    "share previous_share swing",
)
def _(t: Tables):
    return X.with_previous(_shares(t), "senate")


_EV = "(select state, 3 + n_nationkey % 7 as ev from states)"


def _national_oracle(office: str, k: int, keep: str) -> str:
    stored = "house" if office == "midterm" else office
    ev = "ev_dem, ev_rep, " if office == "president" else ""
    return f"""
select year, dv / (dv + rv) as dem_share, dv / (dv + rv) - pd / nullif(pt, 0) as swing, {ev}ballots,
  ballots / (population * 0.74) as turnout, flips
from (
  select b.year, sum(b.ballots * s.share) as dv, sum(b.ballots * (1 - s.share)) as rv,
    sum(case when s.share is not null then b.ballots end) as ballots, sum(b.population) as population,
    cast(sum(case when s.share > 0.5 then e.ev end) as bigint) as ev_dem, cast(sum(case when s.share <= 0.5 then e.ev end) as bigint) as ev_rep,
    count(*) filter (where s.share is not null and q.share is not null and (s.share > 0.5) <> (q.share > 0.5)) as flips,
    sum(c.ballots * q.share) as pd, sum(case when q.share is not null then c.ballots end) as pt
  from {_BALLOTS} b left join {_SHARES} s on s.state = b.state and s.year = b.year and s.office = '{stored}'
  left join {_SHARES} q on q.state = b.state and q.year = b.year - {k} and q.office = '{stored}'
  left join {_BALLOTS} c on c.state = b.state and c.year = b.year - {k}
  left join {_EV} e on e.state = b.state
  where {keep} group by 1) x"""


for _office, _k, _keep in (
    ("president", 4, "b.year % 4 = 0"), ("midterm", 4, "b.year % 4 <> 0"), ("senate", 6, "true"),
    ("house", 2, "true"),
):

    @query(
        f"exp03_national_totals_{_office}", _national_oracle(_office, _k, _keep),
        "dem_share swing turnout",
    )
    def _(t: Tables, office=_office):
        votes = t.sql("select state, 3 + n_nationkey % 7 as ev from states")
        return X.national_totals(_shares(t), _ballots(t), votes, office)


_SEATS = """(select year, winner_party as party, count(*) as seats from races where office = 'house' and not special
  group by 1, 2)"""


def _control(seats: str, need: int, senate: bool) -> str:
    tie = f"when d = {need - 1} then '50-50' " if senate else ""
    return f"""
select year, d, r, p as previous_d, pr as previous_r, case when d >= {need} then 'DEM' {tie}else 'REP' end as control,
  case when (p >= {need}) <> (d >= {need}) then 'flipped' when p is not null then 'held' end as change
from (
  select a.year, a.d, a.r, b.d as p, b.r as pr from (
    select year, cast(coalesce(sum(case when party = 'DEM' then seats end), 0) as bigint) as d,
      cast(coalesce(sum(case when party = 'REP' then seats end), 0) as bigint) as r from {seats} s group by 1) a
  left join (
    select year, cast(coalesce(sum(case when party = 'DEM' then seats end), 0) as bigint) as d,
      cast(coalesce(sum(case when party = 'REP' then seats end), 0) as bigint) as r from {seats} s group by 1) b
  on b.year = a.year - 2) x"""


@query("exp04_house_control", _control(_SEATS, 218, False))
def _(t: Tables):
    races = L.regular_races(L.stored_summary(t("election_results")), "house")
    seats = races.groupBy("year", F.col("winner_party").alias("party")).agg(
        F.count(F.lit(1)).alias("seats")
    )
    return X.chamber_control(seats, "house")


_HELD = """(select y.year, w.winner_party as party, count(*) as seats
  from (select distinct year from races where office = 'senate' and not special) y
  join (select *, lead(year) over (partition by state, seat order by year) as until from (
    select state, year % 2 as seat, year, winner_party from races where office = 'senate' and not special) z) w
  on w.year <= y.year and (w.until is null or w.until > y.year) group by 1, 2)"""


def _senate(t: Tables):
    # Two classes of seats per state, up in odd and even years of the data.
    return L.regular_races(L.race_summary(t("election_results")), "senate").select(
        "state", (F.col("year") % 2).alias("seat"), "year", "winner_party"
    )


@query("exp04_seat_holders", f"select * from {_HELD} h")
def _(t: Tables):
    return X.seat_holders(_senate(t), ["state", "seat"])


@query("exp04_senate_control", _control(_HELD, 51, True))
def _(t: Tables):
    races = _senate(t)
    return X.chamber_control(X.seat_holders(races, ["state", "seat"]), "senate")


@query(
    "exp05_last_contested",
    f"""select state, year as last_year, share from (select *, row_number() over (partition by state order by
    case when year <= 1997 then 0 else 1 end, year desc) as rn from {_SHARES} s where office = 'senate') x where rn = 1""",
    "share",
)
def _(t: Tables):
    return X.last_contested(_shares(t), "senate", 1997)


@query(
    "exp05_state_lean",
    f"""select state, year, share - sum(ballots * share) over (partition by year) / sum(ballots) over (partition by year) as lean
    from (select s.state, s.year, s.share, b.ballots from {_SHARES} s join {_BALLOTS} b on b.state = s.state and b.year = s.year
    where s.office = 'president' and s.year % 4 = 0) x""",
    "lean",
)
def _(t: Tables):
    return X.state_lean(_shares(t), _ballots(t))


@query(
    "exp06_state_against_mean",
    """select assessment_year, grade, subject, max(case when state = 'MA' then average_score end) as state_value,
    avg(average_score) as all_state_mean,
    max(case when state = 'MA' then average_score end) - avg(average_score) as difference from naep group by 1, 2, 3""",
    "all_state_mean difference",
)
def _(t: Tables):
    return X.against_mean(t("naep"), "MA", ["assessment_year", "grade", "subject"], "average_score")


@query(
    "exp06_score_matrix",
    """select assessment_year, avg(case when subject = 'mathematics' and grade = 4 then average_score end) as mathematics_g4,
    avg(case when subject = 'mathematics' and grade = 8 then average_score end) as mathematics_g8,
    avg(case when subject = 'reading' and grade = 4 then average_score end) as reading_g4,
    avg(case when subject = 'reading' and grade = 8 then average_score end) as reading_g8 from naep where state = 'MA' group by 1""",
)
def _(t: Tables):
    return X.score_matrix(t("naep"), "MA")
