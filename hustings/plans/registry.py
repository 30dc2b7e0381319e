"""Registration of queries together with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bridge
from .checks import CTES

DIGITS = 9


class Tables:
    """The canonical tables derived from one folder of base tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __call__(self, name: str) -> DataFrame:
        return bridge.table(self.spark, self.sf_dir, name)

    def base(self, name: str) -> DataFrame:
        return bridge.base(self.spark, self.sf_dir, name)

    def sql(self, text: str) -> DataFrame:
        return bridge.run_sql(self.spark, self.sf_dir, text)

    def many(self, names: str) -> dict[str, DataFrame]:
        return bridge.tables(self.spark, self.sf_dir, names.split())


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    oracle: str | None


QUERIES: dict[str, Query] = {}


def rounded(df: DataFrame, names: str) -> DataFrame:
    return df.withColumns({c: F.round(c, DIGITS) for c in names.split()})


def missing_shares(sql: str) -> str:
    """Statement: the share of NULLs of each column of ``sql``."""
    return f"""select n as "column", round(avg(cast(v is null as int)), 3) as missing
    from (select cast(columns(*) as varchar) from ({sql}) w) unpivot include nulls (v for n in (columns(*))) group by 1"""


def query(name: str, oracle: str | None = None, ratios: str = ""):
    """Register ``build(tables)``. Columns named in ``ratios`` are derived by
    division or averaging and compared after rounding to nine digits."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = build(Tables(spark, sf_dir))
            return rounded(df, ratios) if ratios else df

        sql = oracle
        if sql is not None and ratios:
            replaced = ", ".join(f"round({c}, {DIGITS}) as {c}" for c in ratios.split())
            sql = f"select * replace ({replaced}) from ({sql}) q"
        QUERIES[name] = Query(
            name, run, None if sql is None else bridge.with_tables(sql, CTES)
        )
        return build

    return register
