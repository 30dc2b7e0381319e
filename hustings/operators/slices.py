"""The rows a feature build can choose from, and the provenance of its families,
from one pass over each table.

A pass groups a table by the keys within which its features choose a row, and
keeps of each group the row they would choose, together with the facts of the
family's provenance: rows, datasets, runs, last publication day. Both combine below the
shuffle, so what is stored is one row per key: a state, a state and month, a
candidate. The feature operators then run on these rows and give what they would give on
the whole table. Tables whose features need every row of a period (polls) keep
the rows of that period, repeated rows with their number.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import to_double
from ..session import materialize
from . import candidates as C
from . import demographics as D
from . import economics as E
from .pit import filter_as_of
from .polls import AVERAGE_DAYS, SPECIAL_DAYS
from .turnout import TURNOUT_COLUMNS

_REVISION = ("publication_date", "retrieval_date", "revision_vintage")


@dataclass(frozen=True)
class Slice:
    """What one pass leaves of a table: ``rows`` for the features, ``facts`` for the provenance."""

    rows: DataFrame
    facts: DataFrame


def _facts(df: DataFrame, allowed: Column, sets: bool = True) -> list[Column]:
    """Partial provenance of the rows that are ``allowed``. Sets hold dataset and run ids:
    few, however many rows a load has. Without ``sets``, these are left to the caller."""

    def of(name: str, kind: str) -> Column:
        return F.when(allowed, F.col(name)) if name in df.columns else F.lit(None).cast(kind)

    estimated = F.lit(None).cast("bigint")
    if "publication_date_estimated" in df.columns:
        estimated = F.sum(F.when(allowed, F.coalesce("publication_date_estimated", F.lit(False)).cast("bigint")))
    ids = [
        F.collect_set(of("dataset_id", "string")).alias("_datasets"),
        F.collect_set(of("ingestion_run_id", "string")).alias("_runs"),
    ]
    return [
        F.count_if(allowed).alias("_rows"),
        *(ids if sets else []),
        F.max(of("publication_date", "date")).cast("date").alias("_published"),
        estimated.alias("_estimated"),
    ]


_FACT_NAMES = ("_rows", "_datasets", "_runs", "_published", "_estimated")


def provenance(facts: Mapping[str, DataFrame | None], notes: Mapping[str, str], spark) -> DataFrame:
    """One row per family from partial facts, in one aggregation: rows, datasets, runs, last
    publication day, estimated share. A family without facts has no rows."""
    none = spark.createDataFrame([(f, n, notes.get(f, ""), 0, [], []) for n, f in enumerate(facts)],
        "family string, _no int, note string, _rows bigint, _datasets array<string>, _runs array<string>")
    parts = [df.withColumn("family", F.lit(family)) for family, df in facts.items() if df is not None]
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [none, *parts])

    def union(name: str) -> Column:
        # A set of the different sets: as few as the ids in them.
        return F.array_sort(F.array_distinct(F.flatten(F.collect_set(name))))

    rows = every.groupBy("family").agg(
        F.max("_no").alias("_no"),
        F.max("note").alias("note"),
        F.sum("_rows").alias("rows"),
        union("_datasets").alias("datasets"),
        union("_runs").alias("ingestion_runs"),
        F.max("_published").alias("max_publication_date"),
        F.round(F.sum("_estimated") / F.nullif(F.sum("_rows"), F.lit(0)), 3).alias("publication_date_estimated_share"),
    )
    return rows.orderBy("_no").select(
        "family", "rows", "datasets", "ingestion_runs", "max_publication_date", "publication_date_estimated_share", "note"
    )


def facts_of(df: DataFrame) -> DataFrame:
    """The facts of a whole frame as one row."""
    return df.agg(*_facts(df, F.lit(True)))


def _newest_per_key(
    df: DataFrame,
    purpose: str,
    keys: Sequence[str],
    order: Sequence[Column | str],
    values: Sequence[str],
    allowed: Column | None = None,
    only: Column | None = None,
    calendar: bool = True,
) -> Slice:
    """Per key the row that is greatest in ``order`` (NULL counts as the least). Rows that are
    not ``only`` are of no use to the features: they are one group, which only has facts.

    Keys made of states, periods and kinds of measures (``calendar``) are as many as the calendar
    allows, however large the table is: some ten thousand rows, which the features
    then take as one partition, without further shuffles."""
    keys = [k for k in keys if k in df.columns]
    ranks = [F.col(o) if isinstance(o, str) else o for o in order if not isinstance(o, str) or o in df.columns]
    kept = [c for c in dict.fromkeys([*values, *_REVISION]) if c in df.columns and c not in keys]
    best = F.struct(*[r.alias(f"_{i}") for i, r in enumerate(ranks)], *kept)
    used = F.lit(True) if only is None else F.coalesce(only, F.lit(False))
    public = F.lit(True) if allowed is None else F.coalesce(allowed, F.lit(False))
    by = [F.when(used, F.col(k)).alias(k) for k in keys] if only is not None else [F.col(k) for k in keys]
    one = materialize(
        df.groupBy(*by, used.alias("_used"), public.alias("_public")).agg(
            F.max(F.when(used, best)).alias("_best"), *_facts(df, public)
        ),
        f"slice-{purpose}",
    )
    rows = one.where("_used").select(*keys, *[F.col(f"_best.{c}").alias(c) for c in kept])
    return Slice(rows.coalesce(1) if calendar else rows, one.select(*_FACT_NAMES))


def _rows_of(df: DataFrame, purpose: str, values: Sequence[str], only: Column) -> Slice:
    """The rows that are ``only``, each as often as it stands there; all others leave facts.

    There are nearly as many groups as used rows, so the ids of datasets and runs are keys rather
    than sets: numbers and days alone are aggregated by hashing, sets would sort all rows."""
    values = [c for c in dict.fromkeys(values) if c in df.columns]
    used = F.coalesce(only, F.lit(False))
    ids = {"_datasets": "dataset_id", "_runs": "ingestion_run_id"}
    of_id = [(F.col(c) if c in df.columns else F.lit(None)).cast("string").alias(name) for name, c in ids.items()]
    one = materialize(
        df.groupBy(*[F.when(used, F.col(c)).alias(c) for c in values], used.alias("_used"), *of_id)
        .agg(*_facts(df, F.lit(True), sets=False))
        .withColumns({name: F.array_compact(F.array(name)) for name in ids}),
        f"slice-{purpose}",
    )
    # `_rows` counts equal rows: they are one group.
    rows = one.where("_used").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_rows").cast("int"))))
    return Slice(rows.select(*values), one.select(*_FACT_NAMES))


def _held_first(df: DataFrame, cut: dt.date) -> list[Column]:
    """:func:`pit.snapshot_order` as ascending values: the newest retrieval made by the day, else the oldest."""
    if "retrieval_date" not in df.columns:
        return []
    day = F.to_date("retrieval_date")
    held = F.coalesce(day <= F.lit(cut), F.lit(False))
    return [held, F.when(held, F.col("retrieval_date")), F.when(~held, -F.unix_date(day))]


def _polls(df: DataFrame, cut: dt.date, year: int, office: str, purpose: str) -> Slice:
    values = ["state", "district", "year", "office", "end_date", "poll_margin", "dem_pct", "rep_pct", "sample_size",
              "poll_id", "publication_date"]
    return _rows_of(df, purpose, values, (F.col("year") == year) & (F.col("office") == office))


def _recent(values: Sequence[str], date_col: str, days: int):
    def take(df: DataFrame, cut: dt.date, year: int, office: str, purpose: str) -> Slice:
        first = cut - dt.timedelta(days=days)
        return _rows_of(df, purpose, [*values, date_col, "publication_date"], F.col(date_col) > F.lit(first))

    return take


def _by(keys: str, order: str, values: Sequence[str]):
    def take(df: DataFrame, cut: dt.date, year: int, office: str, purpose: str) -> Slice:
        return _newest_per_key(df, purpose, keys.split(), order.split(), [*values, *order.split()])

    return take


def _population(df: DataFrame, cut: dt.date, year: int, office: str, purpose: str) -> Slice:
    vintage = [to_double("revision_vintage")] if "revision_vintage" in df.columns else []
    return _newest_per_key(df, purpose, ["state", "year"], vintage, ["population", *D.MIGRATION])


def _snapshots(keys: str, values: str):
    def take(df: DataFrame, cut: dt.date, year: int, office: str, purpose: str) -> Slice:
        order = [*_held_first(df, cut), "publication_date", "revision_vintage"]
        if not _held_first(df, cut):
            order = [c for c in _REVISION if c != "retrieval_date"]
        return _newest_per_key(df, purpose, keys.split(), order, values.split())

    return take


def _industry(df: DataFrame, cut: dt.date, year: int, office: str, purpose: str) -> Slice:
    one = materialize(E.industry_by_year(df, _facts(df, F.lit(True))), f"slice-{purpose}")
    return Slice(one.drop(*_FACT_NAMES).coalesce(1), one.select(*_FACT_NAMES))


def _accounts(df: DataFrame, cut: dt.date, year: int, office: str, purpose: str) -> Slice:
    known = df.withColumn("_known", F.col("value").isNotNull())
    return _newest_per_key(known, purpose, ["state", "year", "measure", "_known"], [*_REVISION, "value"], ["value"])


def _candidates(df: DataFrame, cut: dt.date, year: int, office: str, purpose: str) -> Slice:
    values = ["candidate_id", "cycle", "office", "election_year", "candidate_status", "state", "district", "party",
              "incumbent_challenger_status"]
    if "candidate_id" not in df.columns:
        return _rows_of(df, purpose, [*values, *_REVISION], F.col("cycle") == year)
    order = [*_held_first(df, cut), "publication_date", "revision_vintage"]
    return _newest_per_key(df, purpose, ["candidate_id", "cycle"], order, values, only=F.col("cycle") == year, calendar=False)


def _finance(df: DataFrame, cut: dt.date, year: int, office: str, purpose: str) -> Slice:
    held = df.where((F.col("cycle") == year) & (F.to_date("retrieval_date") <= F.lit(cut)))
    values = ["state", "district", "party", "cycle", "coverage_end_date", *C.MONEY]
    public = F.to_date("publication_date") <= F.lit(cut)
    return _newest_per_key(
        held, purpose, ["office", "candidate_id", "retrieval_date"], ["coverage_end_date", "revision_vintage"], values,
        public, calendar=False,
    )


def _naep(df: DataFrame, cut: dt.date, year: int, office: str, purpose: str) -> Slice:
    public = F.to_date("publication_date") <= F.lit(cut)
    order = ["assessment_year", "publication_date", "revision_vintage"]
    return _newest_per_key(df, purpose, ["state", "grade", "subject"], order, ["average_score", "assessment_year"], public)


def _religion(df: DataFrame, cut: dt.date, year: int, office: str, purpose: str) -> Slice:
    shares = [c for c in df.columns if c.startswith("pct_")]
    order = ["survey_year", "publication_date", "revision_vintage"]
    return _newest_per_key(df, purpose, ["state"], order, [*shares, "survey_year"])


_YEARLY = "year publication_date revision_vintage"
_POLL_DAYS = 30 + max(AVERAGE_DAYS)

#: How each table is passed over. Families whose rule is not "public by the day" come uncut.
PASSES = {
    "turnout": _by("state year", "publication_date retrieval_date revision_vintage", TURNOUT_COLUMNS),
    "demographics": _by("state survey", _YEARLY, [*D.DEMOGRAPHIC_FEATURES, "total_population"]),
    "population": _population,
    "geography": _by("state", _YEARLY, ["land_area_sq_miles"]),
    "urban_rural": _by("state", _YEARLY, ["pct_urban", "pct_rural"]),
    "labor": _snapshots("state date seasonally_adjusted", "unemployment_rate employment labor_force"),
    "industry": _industry,
    "state_economy": _accounts,
    "national_economy": _snapshots("measure seasonally_adjusted date", "value"),
    "candidates": _candidates,
    "candidate_finance": _finance,
    "polls": _polls,
    "approval_polls": _recent(["approve", "net_approval", "sample_size"], "end_date", _POLL_DAYS),
    "generic_ballot_polls": _recent(["generic_margin", "generic_dem", "generic_rep", "sample_size"], "end_date", _POLL_DAYS),
    "special_elections": _recent(["special_election_swing"], "election_date", max(SPECIAL_DAYS)),
    "naep": _naep,
    "religion": _religion,
}
_UNCUT = {"candidate_finance", "naep"}


def take(name: str, df: DataFrame, year: int, office: str, cut: dt.date) -> Slice:
    """The stored pass over the table of that name."""
    if name not in _UNCUT:
        df = filter_as_of(df, cut, keep_unknown=name == "candidates")
    return PASSES[name](df, cut, year, office, name.replace("_", "-"))
