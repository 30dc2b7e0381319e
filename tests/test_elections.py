import datetime as dt

import pytest
from pyspark.sql import functions as F

from hustings.operators import elections as L

SCHEMA = (
    "year bigint, state string, office string, candidate string, party string, votes double, "
    "total_votes double, special boolean"
)

ROWS = [
    (2012, "WI", "president", "ADAMS", "DEM", 300.0, 560.0, False),
    (2012, "WI", "president", "BAKER", "REP", 200.0, 560.0, False),
    (2012, "WI", "president", "CLARK", "LIB", 40.0, 560.0, False),
    (2012, "WI", "president", "Blank Votes", "OTHER", 20.0, 560.0, False),
    (2012, "IA", "president", "ADAMS", "DEM", 100.0, 200.0, False),
    (2012, "IA", "president", "BAKER", "REP", 100.0, 200.0, False),
    (2016, "WI", "president", "DAVIS", "DEM", 240.0, 500.0, False),
    (2016, "WI", "president", "EVANS", "REP", 260.0, 500.0, False),
    (2016, "IA", "president", "DAVIS", "DEM", 80.0, 200.0, False),
    (2016, "IA", "president", "EVANS", "REP", 120.0, 200.0, False),
    (2010, "WI", "senate", "FOX", "DEM", 55.0, 100.0, False),
    (2010, "WI", "senate", "GRANT", "REP", 45.0, 100.0, False),
    (2012, "WI", "senate", "HALL", "DEM", 40.0, 100.0, False),
    (2012, "WI", "senate", "IVES", "REP", 60.0, 100.0, False),
    (2016, "WI", "senate", "FOX", "DEM", 48.0, 100.0, False),
    (2016, "WI", "senate", "JONES", "REP", 52.0, 100.0, False),
    (2016, "IA", "senate", "KING", "DEM", 45.0, 110.0, True),
    (2016, "IA", "senate", "LANE", "REP", 40.0, 110.0, True),
    (2016, "IA", "senate", "MOORE", "REP", 25.0, 110.0, True),
    (2014, "IA", "senate", "NASH", "REP", 70.0, 70.0, False),
]


@pytest.fixture(scope="module")
def results(spark):
    rows = spark.createDataFrame(ROWS, SCHEMA)
    return rows.select(
        "*",
        F.when(F.col("state") == "WI", "55").otherwise("19").alias("state_fips"),
        F.lit("statewide").alias("district"),
        F.lit("general").alias("election_type"),
        F.make_date(F.col("year").cast("int"), F.lit(11), F.lit(6)).alias("election_date"),
        F.make_date(F.col("year").cast("int"), F.lit(11), F.lit(6)).alias("publication_date"),
        F.lit(True).alias("publication_date_estimated"),
        F.lit(dt.date(2020, 1, 1)).alias("retrieval_date"),
        F.lit("v").alias("revision_vintage"),
        F.lit("MEDSL").alias("source"),
        F.lit("medsl-senate").alias("dataset_id"),
        F.lit("r1").alias("ingestion_run_id"),
    )


@pytest.fixture(scope="module")
def summary(results):
    return L.race_summary(results).cache()


def race(df, **key):
    for column, value in key.items():
        df = df.where(F.col(column) == value)
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_totals_leave_out_blank_votes(summary):
    wi = race(summary, state="WI", year=2012, office="president")
    assert (wi.dem_votes, wi.rep_votes, wi.other_votes) == (300.0, 200.0, 40.0)
    assert wi.total_candidate_votes == 540.0 and wi.total_votes == 560.0
    assert wi.dem_two_party_share == pytest.approx(0.6)
    assert wi.dem_rep_margin == pytest.approx(0.2)
    assert wi.n_candidates == 3 and wi.winner_party == "DEM" and wi.dem_candidate == "ADAMS"
    assert wi.winning_margin == pytest.approx(100 / 540)
    assert not wi.uncontested and wi.observation_date == wi.election_date


def test_winner_is_the_top_candidate_not_the_top_party(summary):
    special = race(summary, state="IA", year=2016, office="senate")
    assert special.special and special.rep_votes == 65.0
    assert special.winner_party == "DEM" and special.rep_candidate == "LANE"


def test_single_candidate_race(summary):
    alone = race(summary, state="IA", year=2014, office="senate")
    assert alone.uncontested and alone.winning_margin == pytest.approx(1.0)
    assert alone.dem_candidate is None and alone.dem_two_party_share == 0.0


def test_ties_go_to_the_alphabetically_first(summary):
    tie = race(summary, state="IA", year=2012, office="president")
    assert tie.winner_party == "DEM" and tie.winning_margin == 0.0


def test_no_votes_at_all_gives_null_shares(spark, results):
    none = L.race_summary(results.where("year = 2010").withColumn("votes", F.lit(None).cast("double")))
    row = none.first()
    assert row.dem_two_party_share is None and row.winning_margin is None and row.uncontested


def test_primary_rows_are_left_out(results):
    primaries = results.withColumn("election_type", F.lit("primary"))
    assert L.race_summary(primaries).count() == 0


def test_null_race_keys_keep_their_runner_up(results):
    rows = results.where("year = 2010").withColumn("state_fips", F.lit(None).cast("string"))
    assert L.race_summary(rows).first().winning_margin == pytest.approx(0.1)


def test_national_share_and_lean(summary):
    national = {
        r.year: r.national_dem_two_party_share
        for r in L.national_two_party_share(summary).collect()
    }
    assert national[2012] == pytest.approx(400 / 700) and national[2016] == pytest.approx(320 / 700)
    lean = L.presidential_lean(summary)
    first = race(lean, state="WI", year=2012)
    second = race(lean, state="WI", year=2016)
    assert first.state_partisan_lean == pytest.approx(0.6 - 400 / 700)
    expected = (0.6 * second.state_partisan_lean + 0.3 * first.state_partisan_lean) / 0.9
    assert second.weighted_state_lean == pytest.approx(expected)


def test_senate_history_prefers_the_same_class(summary):
    history = L.political_history(summary, "senate")
    row = race(history, state="WI", year=2016)
    assert row.prev_election_year == 2010  # six years earlier, although 2012 is newer
    assert row.prev_dem_share == pytest.approx(0.55)
    assert row.lean_year == 2012  # the presidential race of the same year is not known yet
    assert row.average_dem_share_last_2 == pytest.approx((0.55 + 0.40) / 2)
    assert row.previous_swing == pytest.approx(0.40 - 0.55)
    first = race(history, state="WI", year=2010)
    assert first.prev_election_year is None and first.lean_year is None


def test_other_offices_take_the_most_recent_race(summary):
    row = race(L.previous_same_office(summary, "president"), state="IA", year=2016)
    assert row.prev_election_year == 2012 and row.prev_winner_party == "DEM"


def test_a_race_with_very_many_lines(spark, results):
    """A third of all rows in one race: exact result, cut before the shuffle."""
    rows = [
        (2020, "TX", "senate", f"C{i % 1500}", "DEM" if i % 2 == 0 else "REP",
         float(i * 7919 % 3001), 1e7, False, "48", "statewide")
        for i in range(3000)
    ]
    crowd = spark.createDataFrame(rows, SCHEMA + ", state_fips string, district string")
    votes = sorted(((i * 7919) % 3001 for i in range(3000)), reverse=True)
    got = L.race_summary(crowd.repartition(6))
    row = got.first()
    assert row.n_candidates == 1500 and row.total_candidate_votes == sum(votes)
    assert row.winning_margin == pytest.approx((votes[0] - votes[1]) / sum(votes))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 2, Partial" in plan and "collect_list" not in plan
