"""Poll averages as of a date, from polls that had been released by then."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import cutoff
from .candidates import race_key
from .pit import AsOf, filter_as_of
from .relational import newest, top_per_key, weighted_mean

AVERAGE_DAYS = (7, 30, 90)
SPECIAL_DAYS = (30, 90, 180)
FALLBACK_POLLS = 3


def in_window(
    as_of: AsOf,
    days: int,
    date_col: str = "end_date",
    publication_col: str = "publication_date",
) -> str:
    """Condition: released by ``as_of`` and dated within the ``days`` days up to it."""
    last = cutoff(as_of)
    first = last - dt.timedelta(days=days)
    return (
        f"coalesce({date_col} > date'{first}' and {date_col} <= date'{last}' "
        f"and {publication_col} <= date'{last}', false)"
    )


def poll_window(df: DataFrame, as_of: AsOf, days: int, date_col: str = "end_date") -> DataFrame:
    return df.where(in_window(as_of, days, date_col))


def _weight(df: DataFrame) -> str | None:
    return "sample_size" if "sample_size" in df.columns else None


def approval_features(approval: DataFrame, as_of: AsOf) -> DataFrame:
    """One row: 7/30/90-day means of approval and net approval, the change
    against the same 30-day mean as of 30 days earlier, and the poll count.
    Every window is a condition inside one aggregation over one scan."""
    weight = _weight(approval)
    month_ago = cutoff(as_of) - dt.timedelta(days=30)
    rows = filter_as_of(approval, as_of)
    means = {}
    for days in AVERAGE_DAYS:
        window = in_window(as_of, days)
        means[f"approval_average_{days}d"] = weighted_mean("approve", weight, window)
        means[f"net_approval_{days}d"] = weighted_mean("net_approval", weight, window)
    previous = weighted_mean("approve", weight, in_window(month_ago, 30))
    return rows.agg(
        *[value.alias(name) for name, value in means.items()],
        previous.alias("_previous"),
        F.expr(f"count_if({in_window(as_of, 30)})").alias("n_approval_polls_30d"),
    ).select(
        *means,
        (F.col("approval_average_30d") - F.col("_previous")).alias("approval_change_30d"),
        "n_approval_polls_30d",
    )


def generic_ballot_features(generic: DataFrame, as_of: AsOf) -> DataFrame:
    """One row of generic-ballot means, in the same way."""
    weight = _weight(generic)
    month_ago = cutoff(as_of) - dt.timedelta(days=30)
    rows = filter_as_of(generic, as_of)
    means = {
        f"generic_margin_{days}d": weighted_mean("generic_margin", weight, in_window(as_of, days))
        for days in AVERAGE_DAYS
    }
    month = in_window(as_of, 30)
    means["generic_ballot_dem_30d"] = weighted_mean("generic_dem", weight, month)
    means["generic_ballot_rep_30d"] = weighted_mean("generic_rep", weight, month)
    previous = weighted_mean("generic_margin", weight, in_window(month_ago, 30))
    return rows.agg(
        *[value.alias(name) for name, value in means.items()],
        previous.alias("_previous"),
        F.expr(f"count_if({month})").alias("n_generic_polls_30d"),
    ).select(
        *means,
        (F.col("generic_margin_30d") - F.col("_previous")).alias("generic_change_30d"),
        "n_generic_polls_30d",
    )


def race_poll_features(
    polls: DataFrame,
    year: int,
    office: str,
    as_of: AsOf,
    election_date: dt.date | str | None = None,
) -> DataFrame:
    """Per race: poll means, dispersion, count and recency.

    The headline means use the last 30 days or, in races without a poll then,
    the last three polls. Both are computed from partially combined data: the
    windows as conditional sums, the last three through a per-race limit that
    applies before the shuffle.
    """
    key = race_key(office)
    weight = _weight(polls)
    rows = filter_as_of(
        polls.where((F.col("year") == year) & (F.col("office") == office)), as_of
    )
    for column in key:
        rows = rows.where(F.col(column).isNotNull())
    week, month = in_window(as_of, 7), in_window(as_of, 30)
    values = {"margin": "poll_margin", "dem": "dem_pct", "rep": "rep_pct"}
    in_month = F.expr(f"count_if({month})")
    windows = rows.groupBy(*key).agg(
        *[
            weighted_mean(column, weight, month).alias(f"_month_{name}")
            for name, column in values.items()
        ],
        weighted_mean("poll_margin", weight, week).alias("polling_average_7d"),
        in_month.alias("number_recent_polls"),
        F.when(in_month > 1, F.expr(f"stddev_samp(if({month}, poll_margin, null))")).alias(
            "polling_uncertainty"
        ),
        F.max("end_date").alias("_last_end"),
    )
    needed = [*key, "end_date", *values.values(), *([weight] if weight else [])]
    ids = [c for c in ("poll_id", "publication_date") if c in rows.columns]
    last_polls = top_per_key(
        rows.select(*needed, *ids), key, [*newest("end_date"), *newest(*ids[::-1])], FALLBACK_POLLS
    )
    fallback = last_polls.groupBy(*key).agg(
        *[
            weighted_mean(column, weight).alias(f"_last_{name}")
            for name, column in values.items()
        ]
    )
    recent = F.col("number_recent_polls") > 0
    last_day = F.lit(cutoff(as_of))
    to_election = F.lit(None).cast("int")
    if election_date is not None:
        to_election = F.datediff(F.lit(cutoff(election_date)), last_day)
    return windows.join(fallback, key, "left").select(
        *key,
        *[
            F.when(recent, F.col(f"_month_{name}"))
            .otherwise(F.col(f"_last_{name}"))
            .alias(f"state_poll_{name}")
            for name in values
        ],
        "polling_average_7d",
        F.col("_month_margin").alias("polling_average_30d"),
        "number_recent_polls",
        "polling_uncertainty",
        F.datediff(last_day, F.col("_last_end")).alias("poll_recency_days"),
        to_election.alias("days_to_election"),
    )


def special_election_swing(specials: DataFrame, as_of: AsOf) -> DataFrame:
    """One row: mean swing of the special elections of the last 30/90/180 days."""
    rows = filter_as_of(specials, as_of)
    return rows.agg(
        *[
            F.expr(
                f"avg(if({in_window(as_of, days, 'election_date')}, special_election_swing, null))"
            ).alias(f"special_election_swing_{days}d")
            for days in SPECIAL_DAYS
        ]
    )
