"""Election operators: candidate lines -> race summaries -> political history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalars import ratio, to_double
from ..session import materialize
from .relational import asof_join, null_safe_join, top_per_key

RACE_KEY = ["state", "state_fips", "year", "office", "district", "special"]

# Ballot lines that are no candidates (compared in upper case).
NON_CANDIDATE_LABELS = (
    "BLANK", "BLANK VOTE", "BLANK VOTES", "VOID", "VOID VOTES", "OVERVOTES", "OVER VOTES",
    "UNDERVOTES", "UNDER VOTES", "SCATTERING", "SCATTERED", "OTHER WRITE-INS",
)

# Weights of the newest, second and third presidential lean.
LEAN_WEIGHTS = (0.6, 0.3, 0.1)

SENATE_TERM_YEARS = 6

_PER_RACE_CONSTANTS = ("source", "source_url", "dataset_id", "ingestion_run_id")
_PER_RACE_NEWEST = (
    "publication_date", "publication_date_estimated", "retrieval_date", "revision_vintage",
)


def candidate_lines(results: DataFrame) -> DataFrame:
    """General-election rows of real candidates, with the blanks filled in."""
    lines = results
    if "election_type" in results.columns:
        lines = lines.where(F.coalesce("election_type", F.lit("general")) == "general")
    label = F.upper(F.coalesce("candidate", F.lit("")))
    return lines.where(~label.isin(*NON_CANDIDATE_LABELS)).withColumns(
        {
            "votes": F.coalesce(to_double("votes"), F.lit(0.0)),
            "special": F.coalesce("special", F.lit(False)),
            "party": F.coalesce("party", F.lit("OTHER")),
        }
    )


def _leader(party: str | None = None) -> Column:
    """Most votes, then candidate and party in alphabetical order: the smallest
    struct, so a plain ``min`` finds it and combines before the shuffle."""
    line = F.struct((F.lit(0.0) - F.col("votes")).alias("v"), "candidate", "party")
    return F.min(line if party is None else F.when(F.col("party") == party, line))


def _stored_lines(results: DataFrame) -> DataFrame:
    """The ballot lines of candidates, equal ones with their number: one pass over the results,
    which combines before its shuffle. Everything about a race is read from these."""
    lines = candidate_lines(results)
    have = set(lines.columns)
    return materialize(
        lines.groupBy(*RACE_KEY, "candidate", "party", "votes").agg(
            F.count(F.lit(1)).alias("n"),
            *[F.max(c).alias(c) for c in ("total_votes", *_PER_RACE_NEWEST) if c in have],
            # Constant within a race; min keeps the result independent of row order.
            *[F.min(c).alias(c) for c in ("election_date", *_PER_RACE_CONSTANTS) if c in have],
        ),
        "ballot-lines",
    )


def race_summary(results: DataFrame) -> DataFrame:
    """One row per race: party totals, leaders, shares, winner and margin.

    The results are read once, now; their lines are stored. Totals are added up per
    candidate, then per race, both combined before their shuffle, and the number of
    candidates is the number of first-step groups, so no distinct aggregate is needed. The
    runner-up's votes need a rank, which is cut to two rows per race
    before its shuffle. A race with very many lines is harmless in each of them.
    """
    lines = _stored_lines(results)
    have = set(lines.columns)

    def votes_of(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("votes") * F.col("n"))), F.lit(0.0))

    party = F.col("party")
    newest_of = [c for c in ("total_votes", *_PER_RACE_NEWEST) if c in have]
    constant = [c for c in ("election_date", *_PER_RACE_CONSTANTS) if c in have]
    per_candidate = lines.groupBy(*RACE_KEY, "candidate").agg(
        votes_of(party == "DEM").alias("dem_votes"),
        votes_of(party == "REP").alias("rep_votes"),
        votes_of(~party.isin("DEM", "REP")).alias("other_votes"),
        _leader().alias("_first"),
        _leader("DEM").alias("_dem"),
        _leader("REP").alias("_rep"),
        *[F.max(c).alias(c) for c in newest_of],
        *[F.min(c).alias(c) for c in constant],
    )
    totals = per_candidate.groupBy(*RACE_KEY).agg(
        *[F.sum(c).alias(c) for c in ("dem_votes", "rep_votes", "other_votes")],
        *[F.min(c).alias(c) for c in ("_first", "_dem", "_rep", *constant)],
        *[F.max(c).alias(c) for c in newest_of],
        F.count("candidate").alias("n_candidates"),
    )

    order = [F.desc("votes"), F.asc("candidate"), F.asc("party")]
    best_two = top_per_key(
        lines.select(*RACE_KEY, "votes", "candidate", "party", "n"),
        RACE_KEY, order, 2, tie_break=False, rank_col="place",
    )
    # A first line that stands there twice is its own runner-up.
    at = F.when((F.col("place") == 1) & (F.col("n") == 1), None).otherwise(F.col("votes"))
    runner_up = best_two.groupBy(*RACE_KEY).agg(F.max(at).alias("_second_votes"))
    ranked = null_safe_join(totals, runner_up, RACE_KEY)
    races = derived_metrics(ranked)
    lead = (F.lit(0.0) - F.col("_first.v")) - F.coalesce("_second_votes", F.lit(0.0))
    out = races.withColumns(
        {
            "dem_candidate": F.col("_dem.candidate"),
            "rep_candidate": F.col("_rep.candidate"),
            "winner_party": F.col("_first.party"),
            "winning_margin": ratio(lead, "total_candidate_votes"),
            "uncontested": (F.col("dem_votes") <= 0) | (F.col("rep_votes") <= 0),
        }
    ).drop("_first", "_dem", "_rep", "_second_votes")
    if "election_date" in out.columns:
        out = out.withColumns(
            {c: F.col("election_date") for c in ("observation_date", "period_start", "period_end")}
        )
    return out


def stored_summary(results: DataFrame) -> DataFrame:
    """Race summaries in the shared folder, for uses that read them several times:
    the lines are then read for one summary, however often that is used."""
    return materialize(race_summary(results), "race-summary")


def derived_metrics(summary: DataFrame) -> DataFrame:
    """Vote shares and margins; a zero denominator gives NULL."""
    filled = summary.withColumns(
        {
            c: F.coalesce(to_double(c), F.lit(0.0))
            for c in ("dem_votes", "rep_votes", "other_votes")
        }
    )
    two_party = F.col("dem_votes") + F.col("rep_votes")
    return (
        filled.withColumn("total_candidate_votes", two_party + F.col("other_votes"))
        .withColumns(
            {
                "dem_vote_share": ratio("dem_votes", "total_candidate_votes"),
                "rep_vote_share": ratio("rep_votes", "total_candidate_votes"),
                "other_vote_share": ratio("other_votes", "total_candidate_votes"),
                "dem_two_party_share": ratio("dem_votes", two_party),
                "rep_two_party_share": ratio("rep_votes", two_party),
            }
        )
        .withColumn("dem_rep_margin", F.col("dem_two_party_share") - F.col("rep_two_party_share"))
    )


def regular_races(summary: DataFrame, office: str) -> DataFrame:
    return summary.where(
        (F.col("office") == office) & ~F.coalesce("special", F.lit(False))
    )


def national_two_party_share(summary: DataFrame) -> DataFrame:
    """National Democratic two-party share per presidential year."""
    totals = (
        regular_races(summary, "president")
        .groupBy("year")
        .agg(F.sum("dem_votes").alias("d"), F.sum("rep_votes").alias("r"))
    )
    return totals.select(
        "year", ratio("d", F.col("d") + F.col("r")).alias("national_dem_two_party_share")
    )


def presidential_lean(summary: DataFrame) -> DataFrame:
    """State share minus national share per presidential year, and its weighted
    mean over the last three elections (weights of missing terms drop out)."""
    lean = (
        regular_races(summary, "president")
        .join(national_two_party_share(summary), "year", "left")
        .select(
            "state",
            "year",
            F.col("dem_two_party_share").alias("pres_dem_two_party_share"),
            "national_dem_two_party_share",
            (F.col("dem_two_party_share") - F.col("national_dem_two_party_share")).alias(
                "state_partisan_lean"
            ),
            *[c for c in ("election_date", "publication_date") if c in summary.columns],
        )
    )
    history = W.partitionBy("state").orderBy("year")
    terms = [F.col("state_partisan_lean")] + [
        F.lag("state_partisan_lean", k).over(history) for k in (1, 2)
    ]
    weighted, mass = F.lit(0.0), F.lit(0.0)
    for weight, term in zip(LEAN_WEIGHTS, terms, strict=True):
        weighted = weighted + F.coalesce(term * F.lit(weight), F.lit(0.0))
        mass = mass + F.when(term.isNotNull(), F.lit(weight)).otherwise(F.lit(0.0))
    return lean.withColumn("weighted_state_lean", ratio(weighted, mass))


_PREVIOUS = (
    "dem_two_party_share", "dem_vote_share", "rep_vote_share", "dem_rep_margin", "winner_party",
    "total_candidate_votes",
)


def _seat_history(summary: DataFrame, office: str) -> DataFrame:
    """Regular races with the seat's earlier outcomes. One row per race of a
    seat is left by now, so a seat's history is a short window."""
    seat = W.partitionBy("state", "district").orderBy("year")
    outcome = F.struct("year", *_PREVIOUS)
    previous = F.max(outcome).over(seat.rangeBetween(W.unboundedPreceding, -1))
    if office == "senate":
        # The same class of seat was up one term ago; else the latest race.
        term = F.max(outcome).over(seat.rangeBetween(-SENATE_TERM_YEARS, -SENATE_TERM_YEARS))
        previous = F.coalesce(term, previous)
    share = "dem_two_party_share"
    return regular_races(summary, office).withColumns(
        {
            "_prev": previous,
            "average_dem_share_last_2": F.avg(share).over(seat.rowsBetween(-2, -1)),
            "average_dem_share_last_3": F.avg(share).over(seat.rowsBetween(-3, -1)),
            "previous_swing": F.lag(share, 1).over(seat) - F.lag(share, 2).over(seat),
        }
    )


def _previous_columns() -> list[Column]:
    return [F.col(f"_prev.{c}").alias(f"prev_{c}") for c in _PREVIOUS] + [
        F.col("_prev.year").alias("prev_election_year")
    ]


def previous_same_office(summary: DataFrame, office: str) -> DataFrame:
    """Per regular race the outcome of the seat's previous election: six years
    earlier for the senate if there was one, else the most recent one."""
    return _seat_history(summary, office).select(
        "state", "district", "office", "year", *_previous_columns()
    )


def political_history(summary: DataFrame, office: str) -> DataFrame:
    """What was known before each race: previous outcome of the seat, rolling
    means, swing, and the newest presidential lean of an earlier year."""
    races = _seat_history(summary, office).select(
        "state",
        "district",
        "year",
        *[c for c in ("election_date",) if c in summary.columns],
        "office",
        *_previous_columns(),
        "average_dem_share_last_2",
        "average_dem_share_last_3",
        "previous_swing",
    ).withColumnsRenamed(
        {
            "prev_dem_two_party_share": "prev_dem_share",
            "prev_rep_vote_share": "prev_rep_share",
            "prev_dem_rep_margin": "prev_margin",
        }
    )
    lean = presidential_lean(summary).select(
        "state",
        F.col("year").alias("lean_year"),
        "state_partisan_lean",
        "pres_dem_two_party_share",
        "national_dem_two_party_share",
        "weighted_state_lean",
    )
    return asof_join(races, lean, ["state"], "year", "lean_year")
