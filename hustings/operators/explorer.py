"""The election explorer's numbers: swings, national totals, chamber control,
a state's history and comparisons between states.

``shares`` is a frame (state, year, office, share) of two-party Democratic shares,
one row per contested race; ``midterm`` reads the house rows of midterm years.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalars import ratio

FIRST_YEAR = 1980
# Years back to the comparable election, seats needed to control
# a chamber, and voting-age share of the population.
YEARS_BACK = {"president": 4, "midterm": 4, "senate": 6, "house": 2}
CONTROL_SEATS = {"house": 218, "senate": 51}
ADULT_SHARE = 0.74


def election_shares(summary: DataFrame) -> DataFrame:
    """Share per state, year and office from race summaries (votes of a state's
    districts are added up)."""
    races = summary.where(~F.coalesce("special", F.lit(False)))
    totals = races.groupBy("state", "year", "office").agg(
        F.sum("dem_votes").alias("d"), F.sum("rep_votes").alias("r")
    )
    return totals.select(
        "state", "year", "office", ratio("d", F.col("d") + F.col("r")).alias("share")
    ).where(F.col("share").isNotNull())


def shares_for(shares: DataFrame, office: str) -> DataFrame:
    """Rows of the selectable office: ``midterm`` is the house off-year."""
    presidential = F.col("year") % 4 == 0
    stored = "house" if office == "midterm" else office
    rows = shares.where(F.col("office") == stored)
    if office == "president":
        return rows.where(presidential)
    return rows.where(~presidential) if office == "midterm" else rows


def valid_years(shares: DataFrame, office: str) -> DataFrame:
    presidential = F.col("year") % 4 == 0
    keep = {"president": presidential, "midterm": ~presidential}.get(office, F.lit(True))
    return shares.where(keep).select("year").distinct()


def with_previous(shares: DataFrame, office: str, first_year: int = FIRST_YEAR) -> DataFrame:
    """Share of the comparable election before and the swing against it. An exact
    year distance is a range window: no self-join."""
    k = YEARS_BACK[office]
    stored = shares.where(F.col("office") == ("house" if office == "midterm" else office))
    years = W.partitionBy("state").orderBy("year").rangeBetween(-k, -k)
    return stored.withColumn(
        "previous_share",
        F.when(F.col("year") - k >= first_year, F.max("share").over(years)),
    ).withColumn("swing", F.col("share") - F.col("previous_share"))


def national_totals(
    shares: DataFrame,
    ballots: DataFrame,
    electoral_votes: DataFrame,
    office: str,
    first_year: int = FIRST_YEAR,
) -> DataFrame:
    """Per year: ballots-weighted share, swing, electoral votes, turnout, flips.

    ``ballots``: state, year, ballots, population. ``electoral_votes``: state, ev.
    """
    k = YEARS_BACK[office]
    stored = shares.where(F.col("office") == ("house" if office == "midterm" else office))
    joined = ballots.join(stored.drop("office"), ["state", "year"], "left").join(
        electoral_votes, "state", "left"
    )
    back = W.partitionBy("state").orderBy("year").rangeBetween(-k, -k)
    old_enough = F.col("year") - k >= first_year
    rows = joined.withColumns(
        {
            "ps": F.when(old_enough, F.max("share").over(back)),
            "pb": F.when(old_enough, F.max("ballots").over(back)),
        }
    )
    if office in ("president", "midterm"):
        wanted = F.col("year") % 4 == 0
        rows = rows.where(wanted if office == "president" else ~wanted)
    contested = F.col("share").isNotNull()
    dem = F.col("share") > 0.5

    def total(value: Column, condition: Column) -> Column:
        return F.sum(F.when(condition, value))

    out = rows.groupBy("year").agg(
        total(F.col("ballots") * F.col("share"), contested).alias("dem_votes"),
        total(F.col("ballots") * (1 - F.col("share")), contested).alias("rep_votes"),
        total(F.col("ballots"), contested).alias("ballots"),
        F.sum("population").alias("population"),
        total(F.col("ev"), contested & dem).alias("ev_dem"),
        total(F.col("ev"), contested & ~dem).alias("ev_rep"),
        F.count_if(contested & F.col("ps").isNotNull() & (dem != (F.col("ps") > 0.5))).alias(
            "flips"
        ),
        total(F.col("pb") * F.col("ps"), F.col("ps").isNotNull()).alias("_pd"),
        total(F.col("pb"), F.col("ps").isNotNull()).alias("_pt"),
    )
    share = ratio("dem_votes", F.col("dem_votes") + F.col("rep_votes"))
    return out.select(
        "year",
        share.alias("dem_share"),
        (share - ratio("_pd", "_pt")).alias("swing"),
        *(["ev_dem", "ev_rep"] if office == "president" else []),
        "ballots",
        ratio("ballots", F.col("population") * ADULT_SHARE).alias("turnout"),
        "flips",
    )


def chamber_control(seats: DataFrame, chamber: str) -> DataFrame:
    """Seats by party per year, who controls the chamber, and whether that
    changed since two years before. ``seats``: year, party, seats."""
    need = CONTROL_SEATS[chamber]
    by_year = seats.groupBy("year").agg(
        F.coalesce(F.sum(F.when(F.col("party") == "DEM", F.col("seats"))), F.lit(0)).alias("d"),
        F.coalesce(F.sum(F.when(F.col("party") == "REP", F.col("seats"))), F.lit(0)).alias("r"),
    )
    # One row per year is left: all years of the republic fit one window.
    before = W.partitionBy(F.lit(1)).orderBy("year").rangeBetween(-2, -2)
    rows = by_year.withColumns(
        {"previous_d": F.max("d").over(before), "previous_r": F.max("r").over(before)}
    )
    leader = F.when(F.col("d") >= need, F.lit("DEM"))
    if chamber == "senate":
        leader = leader.when(F.col("d") == need - 1, F.lit("50-50"))
    changed = (F.col("previous_d") >= need) != (F.col("d") >= need)
    return rows.select(
        "year", "d", "r", "previous_d", "previous_r",
        leader.otherwise(F.lit("REP")).alias("control"),
        F.when(changed, F.lit("flipped")).when(~changed, F.lit("held")).alias("change"),
    )


def seat_holders(races: DataFrame, seat: Sequence[str]) -> DataFrame:
    """Seats by party per year when a seat is held by the winner of its last
    election. ``races``: the seat columns, year, winner_party.

    An election moves one seat from the earlier winner's party to the new one's.
    The moves are summed per year and party, and their running sum is the number
    of seats held: no grid of seats and years is built.
    """
    earlier = F.lag("winner_party").over(W.partitionBy(*seat).orderBy("year"))
    moves = races.withColumn("_earlier", earlier).select(
        "year",
        F.explode(
            F.array(
                F.struct(F.col("winner_party").alias("party"), F.lit(1).alias("n")),
                F.struct(F.col("_earlier").alias("party"), F.lit(-1).alias("n")),
            )
        ).alias("m"),
    )
    net = moves.where(F.col("m.party").isNotNull()).groupBy(
        "year", F.col("m.party").alias("party")
    ).agg(F.sum("m.n").alias("n"))
    # From here on there is one row per year and party.
    parties = net.agg(F.collect_set("party")).scalar()
    every = net.select("year").distinct().withColumn("party", F.explode(parties))
    years = W.partitionBy("party").orderBy("year")
    held = every.join(net, ["year", "party"], "left").withColumn(
        "seats", F.sum(F.coalesce("n", F.lit(0))).over(years)
    )
    return held.where(F.col("seats") > 0).select("year", "party", "seats")


def last_contested(shares: DataFrame, office: str, year: int) -> DataFrame:
    """Per state the newest election up to ``year``, or else its newest one."""
    rows = shares_for(shares, office)
    upto = F.col("year") <= year
    return rows.groupBy("state").agg(
        F.coalesce(
            F.max(F.when(upto, F.struct("year", "share"))), F.max(F.struct("year", "share"))
        ).alias("last")
    ).select("state", F.col("last.year").alias("last_year"), F.col("last.share").alias("share"))


def state_lean(shares: DataFrame, ballots: DataFrame) -> DataFrame:
    """State presidential share minus the ballots-weighted national share."""
    rows = shares_for(shares, "president").join(
        ballots.select("state", "year", "ballots"), ["state", "year"]
    )
    nation = rows.groupBy("year").agg(
        ratio(F.sum(F.col("ballots") * F.col("share")), F.sum("ballots")).alias("nation")
    )
    return rows.join(nation, "year").select(
        "state", "year", (F.col("share") - F.col("nation")).alias("lean")
    )


def against_mean(df: DataFrame, state: str, time: str | Sequence[str], value: str) -> DataFrame:
    """One state's series next to the mean of all states, by time or by time and further columns."""
    return (
        df.groupBy(*([time] if isinstance(time, str) else time))
        .agg(
            F.max(F.when(F.col("state") == state, F.col(value))).alias("state_value"),
            F.avg(value).alias("all_state_mean"),
        )
        .withColumn("difference", F.col("state_value") - F.col("all_state_mean"))
    )


def score_matrix(naep: DataFrame, state: str, value: str = "average_score") -> DataFrame:
    """One state's assessment years by subject and grade."""
    rows = naep.where(F.col("state") == state)
    cells = [(s, g) for s in ("mathematics", "reading") for g in (4, 8)]
    return rows.groupBy("assessment_year").agg(
        *[
            F.avg(
                F.when((F.col("subject") == s) & (F.col("grade") == g), F.col(value))
            ).alias(f"{s}_g{g}")
            for s, g in cells
        ]
    )
