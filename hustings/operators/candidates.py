"""Incumbency and campaign finance per race as of a date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import cutoff
from ..functions.scalars import ratio, to_double
from .pit import AsOf, filter_as_of, snapshot_as_of
from .relational import newest, top_per_key

ACTIVE_STATUS = ("C", "N")


def race_key(office: str) -> list[str]:
    return ["state", "district"] if office == "house" else ["state"]


def _with_key(df: DataFrame, key: list[str]) -> DataFrame:
    for column in key:
        df = df.where(F.col(column).isNotNull())
    return df


def active_candidates(
    candidates: DataFrame, year: int, office: str, as_of: AsOf | None
) -> DataFrame:
    """Statutory or not-yet-qualified candidates of the cycle, as known then: each
    candidate once, as in the stored retrieval that counts on ``as_of``."""
    rows = filter_as_of(candidates.where(F.col("cycle") == year), as_of, keep_unknown=True)
    if "candidate_id" in rows.columns:
        rows = snapshot_as_of(rows, as_of, ["candidate_id", "cycle"])
    rows = rows.where(F.col("office") == office)
    return rows.where(
        (F.coalesce("election_year", F.lit(year)) == year)
        & F.coalesce("candidate_status", F.lit("C")).isin(*ACTIVE_STATUS)
    )


def incumbency_features(
    candidates: DataFrame, year: int, office: str, as_of: AsOf | None = None
) -> DataFrame:
    """Per race: incumbent party, open seat, candidates per major party."""
    key = race_key(office)
    rows = _with_key(active_candidates(candidates, year, office, as_of), key)
    status, party = F.col("incumbent_challenger_status"), F.col("party")

    def seen(condition: Column) -> Column:
        return F.count_if(F.coalesce(condition, F.lit(False))) > 0

    incumbent = status == "I"
    races = rows.groupBy(*key).agg(
        F.count_if(party == "DEM").alias("n_dem_candidates"),
        F.count_if(party == "REP").alias("n_rep_candidates"),
        F.when(seen(incumbent & (party == "DEM")), F.lit("DEM"))
        .when(seen(incumbent & (party == "REP")), F.lit("REP"))
        .when(seen(incumbent), F.lit("OTHER"))
        .alias("incumbent_party"),
        (seen(status == "O") & ~seen(incumbent)).alias("open_seat"),
    )
    held = F.col("incumbent_party")
    return races.withColumns(
        {
            "dem_incumbent": F.coalesce(held == "DEM", F.lit(False)),
            "rep_incumbent": F.coalesce(held == "REP", F.lit(False)),
        }
    )


def usable_snapshot(finance: DataFrame, year: int, office: str | None, as_of: AsOf) -> DataFrame:
    """Rows of the newest bulk snapshot already retrieved on ``as_of``.

    A later snapshot cut back to early reports would hold only candidates who
    stopped filing, so the snapshot as a whole must be old enough.
    """
    rows = finance.where(F.col("cycle") == year)
    if office is not None:
        rows = rows.where(F.col("office") == office)
    held = rows.where(F.to_date("retrieval_date") <= F.lit(cutoff(as_of)))
    newest_snapshot = held.agg(F.max("retrieval_date")).scalar()
    return held.where(F.col("retrieval_date") == newest_snapshot)


_MONEY = {
    "receipts": "total_receipts",
    "disbursements": "total_disbursements",
    "cash_on_hand": "cash_on_hand_end",
    "individual_contributions": "individual_contributions",
}
MONEY = tuple(_MONEY.values())


def finance_features(finance: DataFrame, year: int, office: str, as_of: AsOf) -> DataFrame:
    """Per race the money of each major party's best-funded candidate, from the
    newest report per candidate in the usable snapshot."""
    key = race_key(office)
    reports = filter_as_of(usable_snapshot(finance, year, office, as_of), as_of)
    money = [c for c in _MONEY.values() if c in finance.columns]
    order = ["coverage_end_date", "revision_vintage"]
    needed = reports.select("candidate_id", *key, "party", *money, *order)
    latest = top_per_key(needed, ["candidate_id"], newest(*order))

    def best_funded(party: str) -> Column:
        # Most receipts (unknown last), then candidate id: the smallest struct.
        receipts = to_double("total_receipts")
        line = F.struct(
            receipts.isNull().alias("unknown"), (-receipts).alias("r"), "candidate_id", *money
        )
        return F.min(F.when(F.col("party") == party, line))

    races = _with_key(latest, key).groupBy(*key).agg(
        best_funded("DEM").alias("_dem"),
        best_funded("REP").alias("_rep"),
        F.max("coverage_end_date").alias("finance_coverage_end"),
    )

    def amount(prefix: str, column: str) -> Column:
        if column not in money:
            return F.lit(0.0)
        return F.coalesce(F.col(f"_{prefix}.{column}").cast("double"), F.lit(0.0))

    filled = races.withColumns(
        {
            f"{prefix}_{name}": amount(prefix, column)
            for name, column in _MONEY.items()
            for prefix in ("dem", "rep")
        }
    )
    total = F.col("dem_receipts") + F.col("rep_receipts")
    return filled.select(
        *key,
        *[f"{prefix}_{name}" for name in _MONEY for prefix in ("dem", "rep")],
        F.when(total > 0, ratio("dem_receipts", total)).alias("dem_fundraising_share"),
        F.log1p("dem_receipts").alias("log_dem_receipts"),
        F.log1p("rep_receipts").alias("log_rep_receipts"),
        "finance_coverage_end",
        F.col("_dem.candidate_id").alias("finance_dem_candidate_id"),
        F.col("_rep.candidate_id").alias("finance_rep_candidate_id"),
    )
