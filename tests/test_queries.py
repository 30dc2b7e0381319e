"""Registered queries against their check SQL on the smallest tables."""

import math
import os

import pytest

import __spark_entry__ as entry
from hustings.plans import QUERIES as TABLE_QUERIES

duckdb = pytest.importorskip("duckdb")

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
SAMPLE = (
    "pit02_latest_as_of ele01_race_summary ele06_political_history_senate trn01_turnout_metrics "
    "dem02_population_as_of eco01_unemployment_features eco04_national_features can02_finance_house "
    "pol02_approval_features pol04_race_polls_senate nrm01_normalize_returns nrm10_normalize_acs "
    "dq12_validate_table join04_asof_inclusive exp03_national_totals_president api16_snapshot"
).split()
NAMES = [n for n in ORACLES if n in TABLE_QUERIES] if os.environ.get("ALL_QUERIES") else SAMPLE


def text(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


@pytest.fixture(scope="module")
def oracle():
    from hustings.plans.bridge import BASE_TABLES

    from .conftest import SF_DIR

    con = duckdb.connect()
    for name in BASE_TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{SF_DIR}/{name}.parquet')")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, sf_dir, oracle, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted(tuple(text(row[c]) for c in columns) for row in df.collect())
    cursor = oracle.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert got == sorted(tuple(text(row[i]) for i in order) for row in cursor.fetchall())


def test_every_query_has_a_check():
    assert set(TABLE_QUERIES) <= set(ORACLES)
    assert len(TABLE_QUERIES) > 200


def test_no_query_pairs_rows_or_leaves_the_jvm(spark, sf_dir):
    for name in SAMPLE:
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
            assert bad not in plan, f"{name}: {bad}"


def test_entry(spark, monkeypatch, sf_dir):
    monkeypatch.setattr(entry, "SMOKE_DIR", sf_dir)
    df = entry.entry(spark)
    assert df.count() > 0 and "state_partisan_lean" in df.columns
