"""Partitions that do not grow with the table, and the grouping of ballot lines by hashing."""

from pyspark.sql import functions as F

from hustings.operators import slices
from hustings.plans import QUERIES, bridge
from hustings.sources import normalize as N


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_partitions_grow_with_rows(spark):
    few = bridge.spread(spark.range(100), "id", rows=50)
    many = bridge.spread(spark.range(1000), "id", rows=50)
    assert few.rdd.getNumPartitions() == 4
    assert many.rdd.getNumPartitions() == 20
    assert many.count() == 1000


def test_returns_are_spread(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(bridge.spread, "__defaults__", (500,))
    df = bridge.run_sql(spark, sf_dir, "select * from raw_returns")
    assert "REPARTITION_BY_NUM" in final_plan(df)
    # No second shuffle: the grouping keeps the partitions by order.
    assert df.rdd.getNumPartitions() >= spark.read.parquet(f"{sf_dir}/lineitem.parquet").count() // 500


def test_any_in_group_is_spread(spark, sf_dir):
    assert "REPARTITION_BY_NUM" in final_plan(QUERIES["win07_any_in_group"].run(spark, sf_dir))


LINES = [
    # key, votes, party, total_votes, version, mode
    ("A", 5.0, "DEM", 9.0, "v2", "TOTAL"),
    ("A", 7.0, "ABC", 1.0, "v1", "ABSENTEE"),
    ("B", 2.0, "REP", 8.0, "v3", "ABSENTEE"),
    ("B", 3.0, "DEM", None, "v1", "ELECTION DAY"),
    ("C", None, None, None, None, "TOTAL"),
    ("C", 4.0, "LIB", 3.0, "v1", "ABSENTEE"),
]


def test_modes_with_text_that_differs(spark):
    rows = [(2000, "PA", "house", "01", "general", False, c, None, p, v, t, r, m) for c, v, p, t, r, m in LINES]
    schema = (
        "year long, state string, office string, district string, election_type string, special boolean, "
        "candidate string, party_raw string, party string, votes double, total_votes double, "
        "revision_vintage string, mode string"
    )
    out = N.collapse_modes(spark.createDataFrame(rows, schema))
    got = {r.candidate: (r.votes, r.party, r.total_votes, r.revision_vintage) for r in out.collect()}
    assert got == {
        "A": (5.0, "DEM", 9.0, "v2"),
        "B": (5.0, "DEM", 8.0, "v1"),
        "C": (0.0, None, None, None),
    }


def test_lines_are_not_sorted_to_be_grouped(spark):
    lines = spark.createDataFrame([], (
        "year long, state string, office string, district string, election_type string, special boolean, "
        "candidate string, party_raw string, party string, votes double, mode string"
    ))
    plan = N.collapse_modes(lines)._jdf.queryExecution().sparkPlan().toString().splitlines()
    grouping = [x for x in plan if "Aggregate" in x]
    assert "HashAggregate" in grouping[-1]


def test_orders_of_states_are_joined_once(spark, sf_dir):
    names = "turnout population election_results geography".split()
    for name, df in bridge.tables(spark, sf_dir, names).items():
        assert not any("customer" in f for f in df.inputFiles()), name
        alone = bridge.table(spark, sf_dir, name)
        assert df.schema == alone.schema
        assert sorted(map(str, df.collect())) == sorted(map(str, alone.collect()))
    joined = [n for n, sql in bridge.SQL.items() if "join customer on o_custkey" in sql]
    assert len(joined) > 10
    assert not any("join customer" in bridge.over_stored_orders(bridge.SQL[n]) for n in joined)


def test_polls_are_grouped_by_hashing(spark):
    rows = [(1, "a", "d1", "r1"), (1, "a", "d1", "r1"), (1, "a", "d2", None), (2, "b", "d1", "r2"), (3, "c", None, "r3")]
    df = spark.createDataFrame(rows, "x int, state string, dataset_id string, ingestion_run_id string")
    with_plans = []
    keep = slices.materialize
    try:
        slices.materialize = lambda one, purpose: with_plans.append(one) or one
        got = slices._rows_of(df, "t", ["state", "x"], F.col("x") < 3)
    finally:
        slices.materialize = keep
    plan = with_plans[0]._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan
    assert sorted(map(tuple, got.rows.collect())) == [("a", 1), ("a", 1), ("a", 1), ("b", 2)]
    whole = slices.provenance({"f": slices.facts_of(df)}, {}, spark).collect()
    assert slices.provenance({"f": got.facts}, {}, spark).collect() == whole
