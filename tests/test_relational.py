import random

import pytest
from pyspark.sql import functions as F

from hustings.operators import relational as R


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows under one key."""
    rng = random.Random(7)
    rows = [
        ("hot" if i % 3 == 0 else f"k{i % 50}", rng.randrange(300), i, rng.random()) for i in range(3000)
    ]
    return rows, spark.createDataFrame(rows, "k string, t int, id int, v double")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_per_key_limits_before_the_shuffle(skewed):
    rows, df = skewed
    top = R.top_per_key(df, ["k"], [F.desc("t"), F.desc("id")], 2, tie_break=False)
    expected = {}
    for k, t, i, _ in sorted(rows, key=lambda r: (-r[1], -r[2])):
        expected.setdefault(k, []).append(i)
    got = {}
    for r in top.orderBy(F.desc("t"), F.desc("id")).collect():
        got.setdefault(r.k, []).append(r.id)
    assert got == {k: ids[:2] for k, ids in expected.items()}
    text = plan(top)
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_ties_are_broken_the_same_way_every_time(skewed, spark):
    _, df = skewed
    picks = [
        {r.k: r.id for r in R.top_per_key(df.repartition(n), ["k"], [F.desc("t")]).collect()}
        for n in (1, 3, 7)
    ]
    assert picks[0] == picks[1] == picks[2]


def brute_asof(left, right, strict):
    out = {}
    for k, t, i in left:
        found = [(rt, p) for rk, rt, p in right if rk == k and (rt < t if strict else rt <= t)]
        out[i] = max(found) if found else (None, None)
    return out


@pytest.mark.parametrize("strict", [True, False])
@pytest.mark.parametrize("width", [None, 10])
def test_asof_join_against_brute_force(spark, skewed, strict, width):
    rows, df = skewed
    left = [(k, t, i) for k, t, i, _ in rows[:900]]
    seen, right = set(), []
    for k, t, i, _ in rows[900:1500]:
        if (k, t) not in seen:
            seen.add((k, t))
            right.append((k, t, i))
    ldf = spark.createDataFrame(left, "k string, t1 int, id int")
    rdf = spark.createDataFrame(right, "k string, t2 int, p int")
    bucket = None if width is None else F.floor(F.col("t") / width)
    joined = R.asof_join(ldf, rdf, ["k"], "t1", "t2", strict=strict, bucket=bucket)
    got = {r.id: (r.t2, r.p) for r in joined.collect()}
    assert got == brute_asof(left, right, strict)
    assert "CartesianProduct" not in plan(joined) and "NestedLoop" not in plan(joined)


def test_asof_join_keeps_rows_without_key_or_instant(spark):
    left = spark.createDataFrame([(None, 1, 1), ("a", None, 2), ("a", 5, 3)], "k string, t1 int, id int")
    right = spark.createDataFrame([("a", 2, 9)], "k string, t2 int, p int")
    got = {r.id: r.p for r in R.asof_join(left, right, ["k"], "t1", "t2").collect()}
    assert got == {1: None, 2: None, 3: 9}


@pytest.mark.parametrize(
    ("rows", "expected"),
    [
        ([(0.2, 100.0), (0.4, 300.0)], 0.35),
        ([(0.2, None), (0.4, None)], 0.3),  # no weight at all: plain mean
        ([(None, 100.0), (None, 5.0)], None),
        ([(0.2, 100.0), (0.4, None), (0.6, 300.0)], (20 + 0.4 * 200 + 180) / 600),
        ([(0.2, 0.0), (0.4, None)], 0.3),  # median 0 stands for 1, weights count at least 1
        ([(0.2, 100.0), (None, 300.0), (0.6, 100.0)], 0.4),
        ([], None),
    ],
)
def test_weighted_mean(spark, rows, expected):
    df = spark.createDataFrame(rows, "v double, w double")
    got = df.agg(R.weighted_mean("v", "w").alias("m")).first().m
    assert got == (None if expected is None else pytest.approx(expected))


def test_attach_scalars_and_null_safe_join(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "k string, n int")
    one = df.agg(F.sum("n").alias("total"))
    with_total = R.attach_scalars(df, one)
    assert {r.total for r in with_total.collect()} == {3}
    assert "NestedLoop" not in plan(with_total)
    joined = R.null_safe_join(df, df.withColumnRenamed("n", "m"), ["k"])
    assert {(r.k, r.n, r.m) for r in joined.collect()} == {("a", 1, 1), (None, 2, 2)}


def test_keep_last(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, 20), ("a", None, 30)], "k string, o int, v int")
    assert [r.v for r in R.keep_last(df, ["k"], ["o"]).collect()] == [20]


def test_choosing_rows_does_not_widen_the_scan(spark, tmp_path):
    from hustings.operators.demographics import population_as_of
    from hustings.schema import table_spec

    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    path = str(tmp_path / "population")
    table_spec("population").empty(spark).write.parquet(path)
    text = plan(population_as_of(spark.read.parquet(path), "2020-01-01"))
    schema = text[text.index("ReadSchema") :].splitlines()[0]
    assert "births" not in schema and "source_url" not in schema and "population" in schema
    assert "LessThanOrEqual(publication_date" in text
