"""Relational helpers shared by the operators.

All of them keep hot keys harmless: whatever reaches a single task has been
cut down before the shuffle (partial aggregation or a partial per-key limit).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize


def newest(*names: str) -> list[Column]:
    """Descending order in which NULL counts as the oldest value."""
    return [F.desc_nulls_last(name) for name in names]


def top_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    n: int = 1,
    *,
    tie_break: bool = True,
    rank_col: str | None = None,
) -> DataFrame:
    """First ``n`` rows per key.

    The rank filter becomes a per-key limit below the shuffle, so each map task
    sends at most ``n`` rows of a key, however many rows that key has. Rows
    equal in ``order`` are told apart by a hash of their other columns, which
    makes the choice the same in every run and after every task retry.
    """
    ordering = list(order)
    if tie_break:
        # Maps have no defined hash; every other column takes part.
        others = [
            F.col(f"`{field.name}`")
            for field in df.schema
            if field.name not in keys and "map<" not in field.dataType.simpleString()
        ]
        ordering += [F.xxhash64(*others)] if others else []
    rank = rank_col or "_rank"
    ranked = df.withColumn(rank, F.row_number().over(W.partitionBy(*keys).orderBy(*ordering)))
    kept = ranked.where(F.col(rank) <= n)
    return kept if rank_col else kept.drop(rank)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the newest by ``order`` (for natural-key repeats)."""
    present = [name for name in order if name in df.columns]
    return top_per_key(df, list(keys), newest(*present))


def duplicate_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by several rows, with the number of those rows."""
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)
    )


def attach_scalars(df: DataFrame, *one_rows: DataFrame) -> DataFrame:
    """Add the columns of frames that are aggregates without keys, hence one row
    each, as scalar subqueries: computed once, no join."""
    values, columns = [], []
    for number, one_row in enumerate(one_rows):
        box = f"_scalars_{number}"
        values.append(one_row.select(F.struct(*one_row.columns).alias("v")).scalar().alias(box))
        columns += [F.col(f"{box}.{name}").alias(name) for name in one_row.columns]
    return df.select("*", *values).select(*df.columns, *columns)


def null_safe_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left"
) -> DataFrame:
    """Equi-join in which NULL keys match each other; keys are kept once."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = None
    for k in keys:
        term = left[k].eqNullSafe(renamed[f"_r_{k}"])
        condition = term if condition is None else condition & term
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_time: str,
    right_time: str,
    *,
    strict: bool = True,
    bucket: Column | None = None,
) -> DataFrame:
    """For each left row the latest right row of the same ``by`` key whose
    ``right_time`` is before ``left_time`` (or equal to it unless ``strict``).

    No pair of rows is ever formed. The distinct left instants and the right
    rows are merged into one timeline per key and the last right row is carried
    forward; the answer then joins back on (key, instant). ``right`` holds one
    row per (key, ``right_time``). With many instants per key pass ``bucket``,
    a non-decreasing function of the instant column ``t``: timelines are then cut
    into buckets that are swept in parallel and stored, now, and only one row per bucket, its
    end, takes part in carrying values across buckets.
    """
    by = list(by)
    payload = [c for c in right.columns if c not in by]
    left_side, right_side = (0, 1) if strict else (1, 0)
    instants = (
        left.select(*by, F.col(left_time).alias("t"))
        .where(F.col("t").isNotNull())
        .distinct()
        .select(*by, "t", F.lit(left_side).alias("side"))
    )
    facts = right.where(F.col(right_time).isNotNull()).select(
        *by,
        F.col(right_time).alias("t"),
        F.lit(right_side).alias("side"),
        F.struct(*payload).alias("fact"),
    )
    timeline = instants.unionByName(facts, allowMissingColumns=True)
    span = list(by)
    if bucket is not None:
        timeline = timeline.withColumn("_bucket", bucket)
        span.append("_bucket")
    sweep = W.partitionBy(*span).orderBy("t", "side").rowsBetween(W.unboundedPreceding, 0)
    swept = timeline.withColumn("found", F.last("fact", ignorenulls=True).over(sweep)).drop("fact")
    if bucket is not None:
        # Stored once: the instants' answers and the buckets' ends are both read from it.
        swept = materialize(swept, "timeline")
    found = swept.where(F.col("side") == left_side).drop("side")
    if bucket is not None:
        across = W.partitionBy(*by).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
        ends = swept.groupBy(*span).agg(F.max_by("found", F.struct("t", "side")).alias("last"))
        carried = ends.withColumn("carried", F.last("last", ignorenulls=True).over(across)).drop("last")
        found = found.join(carried, span, "left").withColumn(
            "found", F.coalesce("found", "carried")
        )
    answer = found.select(
        *by,
        F.col("t").alias(left_time),
        *[F.col(f"found.{name}").alias(name) for name in payload],
    )
    return left.join(answer, [*by, left_time], "left")


def weighted_mean(value: str, weight: str | None, when: str = "true") -> Column:
    """Weighted mean of the rows meeting the SQL condition ``when``, as one
    aggregate expression.

    Missing weights count as the median weight (1 if that is 0), weights below
    1 as 1, missing values as the plain mean of the present ones. Without any
    value the result is NULL, without any weight it is the plain mean. All terms
    are sums, so everything but the median combines before the shuffle; the
    median's buffer grows with the number of distinct weights only.
    """
    v = f"if({when}, cast({value} as double), null)"
    if weight is None:
        return F.expr(f"avg({v})")
    w = f"if({when}, cast({weight} as double), null)"
    clipped = f"if({w} is null, null, greatest({w}, 1d))"
    no_weight = f"({when}) and {weight} is null"
    stand_in = f"if(coalesce(median({w}), 0d) = 0, 1d, greatest(median({w}), 1d))"
    weighted = (
        f"coalesce(sum({v} * {clipped}), 0d)"
        f" + avg({v}) * coalesce(sum(if({v} is null, {clipped}, null)), 0d)"
    )
    unweighted = (
        f"coalesce(sum(if({no_weight}, {v}, null)), 0d)"
        f" + avg({v}) * count_if({no_weight} and {value} is null)"
    )
    mass = f"coalesce(sum({clipped}), 0d) + {stand_in} * count_if({no_weight})"
    return F.expr(
        f"case when count({v}) = 0 then null when count({w}) = 0 then avg({v}) "
        f"else ({weighted} + {stand_in} * ({unweighted})) / ({mass}) end"
    )


def pivot_values(
    df: DataFrame, keys: Sequence[str], name_col: str, value_col: str, names: Sequence[str]
) -> DataFrame:
    """Long to wide with a known list of columns: one aggregation, no job to
    discover the names. The first non-NULL value in value order wins."""
    picks = [
        F.min(F.when(F.col(name_col) == name, F.col(value_col))).alias(name) for name in names
    ]
    return df.groupBy(*keys).agg(*picks)
