"""Point-in-time operators: what was public on a given day."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import PointInTimeError
from ..functions.dates import cutoff
from .relational import newest, top_per_key

AsOf = dt.date | dt.datetime | str


def resolve_publication_col(
    df: DataFrame,
    publication_col: str = "publication_date",
    fallback_cols: Sequence[str] = ("retrieval_date",),
) -> str | None:
    """The column the cut should use: the publication day, or the first fallback
    when that column is absent or entirely NULL.

    The second test reads data (until the first non-NULL value), so it is a
    separate call and no part of :func:`filter_as_of`.
    """
    present = publication_col in df.columns
    if present and not df.where(F.col(publication_col).isNotNull()).isEmpty():
        return publication_col
    return next((c for c in fallback_cols if c in df.columns), None)


def filter_as_of(
    df: DataFrame,
    as_of: AsOf | None,
    *,
    publication_col: str = "publication_date",
    fallback_cols: Sequence[str] = ("retrieval_date",),
    strict: bool = True,
    keep_unknown: bool = False,
    resolve: bool = False,
) -> DataFrame:
    """Rows published on or before ``as_of``: a plain filter that Parquet scans
    take over. Rows of unknown publication day are dropped unless
    ``keep_unknown``. Without an ``as_of`` the frame comes back unchanged.
    ``resolve`` looks first (a job that ends at the first value) whether the
    publication column is entirely NULL, and then cuts by the fallback."""
    if as_of is None:
        return df
    column = publication_col
    if resolve and column in df.columns:
        column = resolve_publication_col(df, publication_col, fallback_cols) or column
    if column not in df.columns:
        column = next((c for c in fallback_cols if c in df.columns), None)
        if column is None:
            if strict:
                raise PointInTimeError(
                    f"as_of={cutoff(as_of)}: neither {publication_col!r} nor a fallback column"
                )
            return df
    known = F.to_date(column) <= F.lit(cutoff(as_of))
    if df.schema[column].dataType.simpleString() == "date":
        known = F.col(column) <= F.lit(cutoff(as_of))
    return df.where(known | F.col(column).isNull()) if keep_unknown else df.where(known)


def latest_as_of(
    df: DataFrame,
    as_of: AsOf | None,
    keys: Sequence[str],
    *,
    order_col: str = "observation_date",
    publication_col: str = "publication_date",
    vintage_col: str | None = "revision_vintage",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The newest observation per key that was public on ``as_of``; a revision
    counts only once it had been published. ``columns`` names what is needed
    besides keys and order: choosing a row must not widen the scan."""
    available = filter_as_of(df, as_of, publication_col=publication_col)
    order = [order_col, publication_col, *([vintage_col] if vintage_col else [])]
    order = [c for c in order if c in df.columns]
    if columns is not None:
        available = available.select(*dict.fromkeys([*keys, *order, *columns]))
    return top_per_key(available, keys, newest(*order))


def snapshot_order(as_of: AsOf | None, retrieval_col: str = "retrieval_date") -> list[Column]:
    """Which of several stored retrievals of a row counts on ``as_of``: the newest
    one retrieved by then. Where none is that old, the oldest, which knows the
    least of what came later. Without a date, the newest."""
    if as_of is None:
        return newest(retrieval_col)
    held = F.coalesce(F.to_date(retrieval_col) <= F.lit(cutoff(as_of)), F.lit(False))
    return [
        F.desc(held),
        F.desc_nulls_last(F.when(held, F.col(retrieval_col))),
        F.asc_nulls_last(F.when(~held, F.col(retrieval_col))),
    ]


def snapshot_as_of(
    df: DataFrame,
    as_of: AsOf | None,
    keys: Sequence[str],
    *,
    retrieval_col: str = "retrieval_date",
    then: Sequence[str] = ("publication_date", "revision_vintage"),
) -> DataFrame:
    """One row per key: that of the retrieval which counts on ``as_of``, and within
    it the newest revision. The publication cut is a filter of its own."""
    if retrieval_col not in df.columns:
        return df
    order = newest(*[c for c in then if c in df.columns])
    return top_per_key(df, list(keys), [*snapshot_order(as_of, retrieval_col), *order])


def future_rows(
    df: DataFrame, as_of: AsOf, *, publication_col: str = "publication_date"
) -> DataFrame:
    """One row: how many rows lie after the cut, and the last publication day."""
    if publication_col not in df.columns:
        raise PointInTimeError(f"no column {publication_col!r} to audit")
    day = F.to_date(publication_col)
    return df.agg(
        F.count_if(day > F.lit(cutoff(as_of))).alias("future_rows"),
        F.max(day).alias("max_publication_date"),
    )


def assert_no_future_rows(
    df: DataFrame, as_of: AsOf, *, publication_col: str = "publication_date"
) -> None:
    found = future_rows(df, as_of, publication_col=publication_col).first()
    if found.future_rows:
        raise PointInTimeError(
            f"{found.future_rows} rows published after {cutoff(as_of)} "
            f"(latest {found.max_publication_date})"
        )


def leakage_report(
    df: DataFrame, as_of: AsOf, *, publication_col: str = "publication_date"
) -> DataFrame:
    """One row of counts: rows after the cut, unknown, available, estimated."""
    head = [F.lit(str(cutoff(as_of))).alias("as_of"), F.count(F.lit(1)).alias("rows")]
    if publication_col not in df.columns:
        return df.agg(*head, F.lit(None).cast("string").alias("publication_column"))
    day = F.to_date(publication_col)
    limit = F.lit(cutoff(as_of))
    estimated = F.lit(None).cast("bigint")
    if "publication_date_estimated" in df.columns:
        estimated = F.count_if(F.coalesce("publication_date_estimated", F.lit(False)))
    return df.agg(
        *head,
        F.lit(publication_col).alias("publication_column"),
        F.count_if(day > limit).alias("rows_after_as_of"),
        F.count_if(day.isNull()).alias("rows_unknown_publication"),
        F.count_if(day <= limit).alias("rows_available"),
        estimated.alias("estimated_publication_rows"),
        F.max(day).cast("string").alias("max_publication_date"),
    )


def clip_estimated(
    publication: Column | str, estimated: Column | str, retrieval: Column | str
) -> Column:
    """A value already held was published by then at the latest: estimated
    publication days never lie after the retrieval day."""
    pub = F.col(publication) if isinstance(publication, str) else publication
    est = F.col(estimated) if isinstance(estimated, str) else estimated
    cap = F.col(retrieval) if isinstance(retrieval, str) else retrieval
    return F.when(F.coalesce(est, F.lit(False)) & (pub > cap), cap).otherwise(pub)
