"""Queries over the quality rules: tables with faults put in on purpose."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import SchemaChangeError
from ..operators import elections as L
from ..operators import quality as Q
from ..session import scratch_dir
from ..sources import normalize as N
from ..storage.lake import Lake
from ..storage.load import validate_store
from .registry import Tables, missing_shares, query


def _faulty(t: Tables):
    """Election results with faults in known rows."""
    rows = t("election_results")
    n = F.col("year") + F.length("candidate")
    return rows.withColumns(
        {
            "state": F.when(F.col("year") == 1995, F.lit("ZZ")).otherwise(F.col("state")),
            "state_fips": F.when(F.col("year") == 1996, F.lit("56")).otherwise(F.col("state_fips")),
            "party": F.when(F.col("party") == "GRN", F.lit("Green")).otherwise(F.col("party")),
            "votes": F.when(F.col("year") == 1997, -F.col("votes"))
            .when(F.col("year") == 1998, F.col("total_votes") * 2 + 5)
            .otherwise(F.col("votes")),
            "office": F.when(n % 5 != 0, F.col("office")),
            "observation_date": F.date_add("publication_date", F.when(n % 7 == 0, 3).otherwise(0)),
            "period_start": F.col("election_date"),
            "period_end": F.date_sub("election_date", F.when(F.col("year") == 1999, 1).otherwise(0)),
            "publication_date": F.when(F.col("year") != 2001, F.col("publication_date")),
        }
    )


_FAULTY = """(select * replace (case when year = 1995 then 'ZZ' else state end as state,
  case when year = 1996 then '56' else state_fips end as state_fips,
  case when party = 'GRN' then 'Green' else party end as party,
  case when year = 1997 then -votes when year = 1998 then total_votes * 2 + 5 else votes end as votes,
  case when (year + length(candidate)) % 5 <> 0 then office end as office,
  case when year <> 2001 then publication_date end as publication_date),
  publication_date + cast(case when (year + length(candidate)) % 7 = 0 then 3 else 0 end as int) as observation_date,
  election_date as period_start, election_date - cast(case when year = 1999 then 1 else 0 end as int) as period_end
  from election_results) f"""


def _issues(*selects: str) -> str:
    return " union all ".join(f"select * from ({s}) where \"count\" > 0" for s in selects)


def _rule(rule: str, severity: str, field: str, cond: str) -> str:
    return (
        f"select '{rule}' as rule, '{severity}' as severity, '{field}' as field, "
        f"count(*) filter (where {cond}) as \"count\" from {_FAULTY}"
    )


_KEY = "state, year, office, district, candidate, party_raw, special"
_DUPLICATES = f"""select 'duplicate_key' as rule, 'error' as severity, '{_KEY.replace(' ', '')}' as field,
  cast(sum(n) as bigint) as "count" from (select count(*) as n from {_FAULTY} group by {_KEY} having count(*) > 1) d"""
_EXPECTED = {
    "required_column_null": _rule("required_column_null", "error", "office", "office is null"),
    "duplicate_key": _DUPLICATES,
    "invalid_state": _rule("invalid_state", "error", "state", "state = 'ZZ'"),
    "state_fips_mismatch": _rule(
        "state_fips_mismatch", "error", "state_fips", "state = 'ZZ' or year = 1996"
    ),
    "negative_count": _rule("negative_count", "error", "votes", "votes < 0"),
    "period_start_after_end": _rule(
        "period_start_after_end", "error", "period_start", "period_start > period_end"
    ),
    "publication_before_observation": _rule(
        "publication_before_observation", "warning", "publication_date",
        "publication_date < observation_date",
    ),
    "publication_date_missing": _rule(
        "publication_date_missing", "warning", "publication_date", "publication_date is null"
    ),
    "party_not_canonical": _rule("party_not_canonical", "error", "party", "party = 'Green'"),
    "candidate_votes_exceed_total": _rule(
        "candidate_votes_exceed_total", "error", "votes", "votes > total_votes * 1.001 + 1"
    ),
}


def _found(t: Tables):
    return Q.validate(_faulty(t), "election_results", dataset="d", source="s")


@query("dq12_validate_table", _issues(*_EXPECTED.values()))
def _(t: Tables):
    return _found(t).select("rule", "severity", "field", "count")


for _name, _number in (
    ("required_column_null", "dq01"), ("duplicate_key", "dq02"), ("invalid_state", "dq03"),
    ("state_fips_mismatch", "dq03"), ("negative_count", "dq05"), ("period_start_after_end", "dq06"),
    ("publication_before_observation", "dq07"), ("publication_date_missing", "dq07"),
    ("party_not_canonical", "dq08"), ("candidate_votes_exceed_total", "dq09"),
):

    @query(f"{_number}_{_name}", _issues(_EXPECTED[_name]))
    def _(t: Tables, name=_name):
        return _found(t).where(F.col("rule") == name).select("rule", "severity", "field", "count")


def _shares(t: Tables):
    rows = t("demographics").withColumns(
        {
            "pct_male": F.when(F.col("year") == 1996, F.col("pct_male") * 3).otherwise(F.col("pct_male")),
            "gini_coefficient": F.when(F.col("year") == 1997, F.lit(-0.5)).otherwise(F.lit(0.4)),
        }
    )
    return Q.validate(rows, "demographics")


@query(
    "dq04_shares_in_range",
    """select 'share_out_of_range' as rule, field, "count" from (
    select 'pct_male' as field, count(*) filter (where year = 1996 and pct_male * 3 > 1.000000001) as "count" from demographics
    union all select 'gini_coefficient', count(*) filter (where year = 1997) from demographics) x where "count" > 0""",
)
def _(t: Tables):
    return _shares(t).where(F.col("rule") == "share_out_of_range").select("rule", "field", "count")


@query(
    "dq04_percent_in_range",
    """select 'percent_out_of_range' as rule, 'unemployment_rate' as field, count(*) as "count" from labor
    where unemployment_rate * 4 > 100 having count(*) > 0""",
)
def _(t: Tables):
    rows = t("labor").withColumn("unemployment_rate", F.col("unemployment_rate") * 4)
    return Q.validate(rows, "labor").where(F.col("rule") == "percent_out_of_range").select(
        "rule", "field", "count"
    )


@query(
    "dq06_dates_parseable",
    """select 'unparseable_date' as rule, 'end_date' as field, count(*) as "count" from polls where id % 19 = 0""",
)
def _(t: Tables):
    text = F.when(F.col("id") % 19 == 0, F.lit("soon")).otherwise(F.col("end_date").cast("string"))
    rows = t("polls").withColumn("end_date", text)
    return Q.validate(rows, "polls").where(F.col("rule") == "unparseable_date").select(
        "rule", "field", "count"
    )


@query(
    "dq09_vote_reconciliation",
    """select 'vote_components_mismatch' as rule, 'error' as severity, count(*) as "count" from races where year = 1996
    union all select 'candidate_votes_vs_total', 'warning', count(*) from races
    where total_candidate_votes + (case when year = 1996 then 7 else 0 end) > total_votes * 1.01
      or total_candidate_votes + (case when year = 1996 then 7 else 0 end) < total_votes * 0.9""",
)
def _(t: Tables):
    extra = F.when(F.col("year") == 1996, 7).otherwise(0)
    races = L.race_summary(t("election_results")).withColumn(
        "total_candidate_votes", F.col("total_candidate_votes") + extra
    )
    found = Q.validate(races, "election_race_summary")
    rules = ("vote_components_mismatch", "candidate_votes_vs_total")
    return found.where(F.col("rule").isin(*rules)).select("rule", "severity", "count")


@query(
    "dq10_turnout_consistency",
    """select 'ballots_exceed_registered' as rule, count(*) as "count" from turnout
    where ballots_cast * 2 > registered_voters * 1.05 having count(*) > 0""",
)
def _(t: Tables):
    rows = t("turnout").withColumn("ballots_cast", F.col("ballots_cast") * 2)
    return Q.validate(rows, "turnout").where(
        F.col("rule") == "ballots_exceed_registered"
    ).select("rule", "count")


@query(
    "dq11_share_groups_sum",
    """select 'share_group_sum' as rule, 'pct_urban' as field, count(*) as "count" from urban_rural
    where pct_urban + pct_rural * 0.9 < 0.98 having count(*) > 0""",
)
def _(t: Tables):
    rows = t("urban_rural").withColumn("pct_rural", F.col("pct_rural") * 0.9)
    return Q.validate(rows, "urban_rural").where(F.col("rule") == "share_group_sum").select(
        "rule", "field", "count"
    )


@query(
    "dq13_example_records",
    f"""select 'period_start_after_end' as rule, concat(string_agg(k, ';' order by k), ' (+', max(n) - 5, ' more)') as record
    from (select concat_ws('|', coalesce(state, ''), coalesce(cast(year as varchar), ''), coalesce(office, ''), district, candidate,
      party_raw, cast(special as varchar)) as k, count(*) over () as n from {_FAULTY} where period_start > period_end
      order by k limit 5) x""",
)
def _(t: Tables):
    return _found(t).where(F.col("rule") == "period_start_after_end").select("rule", "record")


@query(
    "dq14_row_count_drift",
    """select dataset, case when abs((row_count - p) / p) > 0.25 then concat(row_count, ' rows, ',
      case when row_count >= p then '+' else '' end, cast(cast(round_even((row_count - p) * 100.0 / p, 0) as bigint) as varchar),
      '% against the ', p, ' of the run before') end as message
    from (select dataset, max(case when rn = 1 then row_count end) as row_count, nullif(max(case when rn = 2 then row_count end), 0) as p
      from (select *, row_number() over (partition by dataset order by started_at desc, run_id desc) as rn
        from ingestion_runs where status = 'success') r group by dataset) x""",
)
def _(t: Tables):
    from ..operators.relational import top_per_key

    runs = t("ingestion_runs").where(F.col("status") == "success").select(
        "dataset", "started_at", "run_id", "row_count"
    )
    order = [F.desc("started_at"), F.desc("run_id")]
    last_two = top_per_key(runs, ["dataset"], order, 2, tie_break=False, rank_col="place")

    def rows_of(place: int):
        return F.max(F.when(F.col("place") == place, F.col("row_count")))

    pairs = last_two.groupBy("dataset").agg(
        rows_of(1).alias("now"), F.nullif(rows_of(2), F.lit(0)).alias("before")
    )
    message = Q.row_count_drift(F.col("before"), F.col("now"))
    return pairs.select("dataset", message.alias("message"))


@query(
    "dq15_audit_frame",
    f"""select a.*, m."column", m.missing from (
      select 'polls' as "table", count(*) as rows, (select count(*) from (describe select * from polls)) as columns,
      cast(coalesce((select sum(n) from (select count(*) as n from polls group by poll_id, state, office, district, year
        having count(*) > 1) d), 0) as bigint) as duplicate_key_rows,
      list_sort(list(distinct dataset_id)) as datasets, count(distinct state) as states from polls) a
    cross join ({missing_shares("select * from polls")}) m""",
)
def _(t: Tables):
    audit = Q.audit_frame(t("polls"), "polls", most=None)
    return audit.select(
        "table", "rows", F.col("columns").cast("bigint").alias("columns"), "duplicate_key_rows",
        "datasets", "states", F.inline("missingness_top"),
    )


@query(
    "dq16_issues_by_severity",
    f"select severity, count(*) as issues from ({_issues(*_EXPECTED.values())}) i group by severity",
)
def _(t: Tables):
    return Q.severity_counts(_found(t))


# Feeds, their normalizers, and a column that each of these cannot do without.
_FEEDS = {
    "raw_returns": ("candidatevotes", lambda df: N.normalize_returns(df, "house", "party")),
    "raw_eavs": ("F1a", lambda df: N.normalize_eavs(df, 2022)),
    "raw_pep": ("STATE", lambda df: N.normalize_pep(df, 2024)),
    "raw_gazetteer": ("ALAND_SQMI", lambda df: N.normalize_gazetteer(df, 2020)),
    "raw_urban": ("POP_URB", lambda df: N.normalize_urban_rural_county(df, 2020)),
    "raw_qcew": ("annual_avg_emplvl", lambda df: N.normalize_qcew(df, 2023)),
    "raw_bea": ("DataValue", lambda df: N.normalize_bea(df, "real_gdp", "SAGDP9N", "1", "bea_annual")),
    "raw_cn": ("CAND_ID", lambda df: N.normalize_candidate_master(df, 2000, dt.date(2001, 12, 31))),
    "raw_finance": ("TTL_RECEIPTS", lambda df: N.normalize_candidate_finance(df, 2000, dt.date(2000, 12, 31))),
    "raw_approval": ("approve", N.normalize_approval_polls),
    "raw_generic": ("generic_dem", N.normalize_generic_ballot),
    "raw_polls": ("dem_pct", N.normalize_race_polls),
    "raw_religion": ("survey_year", N.normalize_religion),
}


@query(
    "dq17_missing_source_columns",
    " union all ".join(
        f"select '{feed}' as feed, '{column}' as missing, count(*) as rows from {feed}"
        for feed, (column, _) in _FEEDS.items()
    ),
)
def _(t: Tables):
    """Every normalizer refuses a file without the column; the rows that it would have taken are counted."""
    refused = []
    for feed, (column, normalize) in _FEEDS.items():
        raw = t.sql(f"select * from {feed}")
        try:
            normalize(raw.drop(column))
        except SchemaChangeError:
            rows = raw.agg(F.count(F.lit(1)).alias("rows"))
            refused.append(rows.select(F.lit(feed).alias("feed"), F.lit(column).alias("missing"), "rows"))
        else:
            raise RuntimeError(f"{feed}: a missing column went unnoticed")
    return reduce(DataFrame.unionByName, refused)


def _store_faults(table: str, dataset: str, faults: str) -> str:
    return f"select '{table}' as \"table\", '{dataset}' as dataset, rule, \"count\" from ({faults}) f where \"count\" > 0"


_LATE = "select 'publication_before_observation' as rule, count(*) as \"count\" from naep where {}"


@query(
    "dq18_validate_store",
    " union all ".join(
        [
            _store_faults("naep", "naep-state", _LATE.format("grade = 4")),
            _store_faults("naep", "naep-trial", _LATE.format("grade <> 4")),
            _store_faults(
                "turnout", "eac-eavs",
                "select 'ballots_exceed_registered' as rule, count(*) as \"count\" from turnout "
                "where ballots_cast * 2 > registered_voters * 1.05",
            ),
        ]
    ),
)
def _(t: Tables):
    lake = Lake(t.spark, scratch_dir(t.spark, "validate"))
    late = t("naep").withColumn("observation_date", F.date_add("publication_date", 1))
    lake.write_processed(late.where("grade = 4"), "naep", "naep-state")
    lake.write_processed(late.where("grade <> 4"), "naep", "naep-trial")
    doubled = t("turnout").withColumns(
        {"observation_date": F.col("publication_date"), "ballots_cast": F.col("ballots_cast") * 2}
    )
    lake.write_processed(doubled, "turnout", "eac-eavs")
    issues, _ok = validate_store(lake)
    return issues.select("table", "dataset", "rule", "count")
