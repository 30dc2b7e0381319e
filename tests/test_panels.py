import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from hustings.operators import candidates as C
from hustings.operators import demographics as D
from hustings.operators import economics as E
from hustings.operators import polls as P
from hustings.operators import turnout as T


def days(df, *names):
    return df.withColumns({n: F.col(n).cast("date") for n in names})


def test_turnout(spark):
    t = spark.createDataFrame(
        [("MN", 2014, 4.0, 2.0, 0.5), ("MN", 2016, 4.0, 3.0, 1.0), ("MN", 2018, 0.0, 2.6, 0.8)],
        "state string, year int, registered_voters double, ballots_cast double, mail_votes double",
    )
    people = spark.createDataFrame(
        [("MN", 2016, 6.0, "2016"), ("MN", 2016, 5.0, "2019"), ("MN", 2016, 9.0, None)],
        "state string, year int, population double, revision_vintage string",
    )
    rows = {r.year: r for r in T.previous_turnout(T.turnout_metrics(t, people)).collect()}
    assert rows[2016].turnout_registered == 0.75 and rows[2016].turnout_population == 0.6
    assert rows[2018].turnout_registered is None  # nobody registered: no rate, no error
    assert rows[2018].previous_turnout_registered == 0.5  # the midterm before, not 2016
    assert rows[2016].previous_turnout_registered is None
    assert rows[2014].turnout_population is None


def labor(spark, months=24):
    rows = []
    for i in range(months):
        day = dt.date(2022 + i // 12, i % 12 + 1, 1)
        rows.append(("OR", day, True, 4.0 + 0.1 * i, 1000.0 + i, 1100.0 + 2 * i))
    df = spark.createDataFrame(
        rows,
        "state string, date date, seasonally_adjusted boolean, unemployment_rate double, "
        "employment double, labor_force double",
    )
    return df.withColumn("publication_date", F.date_add(F.last_day("date"), 21))


def test_unemployment(spark):
    row = E.unemployment_features(labor(spark), "2023-10-15").first()
    assert row.labor_month == dt.date(2023, 8, 1)  # September comes out on October 21
    assert row.unemployment_rate == pytest.approx(4.0 + 0.1 * 19)
    assert row.unemployment_rate_3m_avg == pytest.approx(4.0 + 0.1 * 18)
    assert row.unemployment_change_3m == pytest.approx(0.3)
    assert row.unemployment_change_12m == pytest.approx(1.2)
    assert row.employment_growth_12m == pytest.approx(1019 / 1007 - 1)
    assert row.labor_publication_date == dt.date(2023, 9, 21)


def test_unemployment_uses_calendar_months_not_rows(spark):
    gap = labor(spark).where("date <> date'2023-05-01'")
    row = E.unemployment_features(gap, "2023-10-15").first()
    assert row.unemployment_change_3m is None
    assert row.unemployment_change_12m == pytest.approx(1.2)
    short = E.unemployment_features(labor(spark, 2), "2023-10-15").first()
    assert short.unemployment_rate_3m_avg is None


def test_industry_shares(spark):
    rows = [
        ("NV", 2022, "10", "0", 200.0, 900.0), ("NV", 2022, "10", "1", 10.0, 1.0),
        ("NV", 2022, "10", "2", 10.0, 1.0), ("NV", 2022, "1026", "5", 50.0, 1.0),
        ("NV", 2022, "62", "5", 20.0, 1.0), ("UT", 2021, "10", "0", 90.0, 800.0),
    ]
    df = spark.createDataFrame(
        rows,
        "state string, year int, industry_code string, own_code string, "
        "annual_avg_employment double, annual_avg_weekly_wage double",
    ).withColumn("avg_annual_pay", F.lit(50000.0)).withColumn(
        "publication_date", F.make_date(F.col("year") + 1, F.lit(6), F.lit(30))
    )
    got = E.industry_shares(df, "2023-12-31").collect()
    assert [r.state for r in got] == ["NV"]  # one year for all states
    assert got[0].pct_hospitality == 0.25 and got[0].pct_healthcare == 0.1
    assert got[0].pct_government == 0.1 and got[0].pct_mining is None
    assert E.industry_shares(df, "2021-01-01").count() == 0


def test_state_economy(spark):
    rows = [("KS", y, "real_gdp", v) for y, v in ((2020, 100.0), (2021, 110.0), (2022, 121.0))]
    rows.append(("KS", 2021, "population", 10.0))
    df = spark.createDataFrame(rows, "state string, year int, measure string, value double")
    df = df.withColumn("publication_date", F.make_date(F.col("year") + 1, F.lit(9), F.lit(30)))
    row = E.state_economy_features(df, "2022-12-31").first()
    assert row.state_economy_year == 2021 and row.real_gdp_growth == pytest.approx(0.1)
    assert row.real_gdp_per_capita == pytest.approx(11.0) and row.nominal_gdp is None


def test_national(spark):
    rows = []
    for i in range(30):
        day = dt.date(2021 + i // 12, i % 12 + 1, 1)
        rows += [
            (day, "cpi_all_items", False, 100 * 1.002**i),
            (day, "cpi_all_items", True, 100 * 1.002**i),
            (day, "nonfarm_payrolls", False, 1000.0 + i),  # no adjusted rows: falls back
            (day, "average_hourly_earnings", True, 20 * 1.004**i),
        ]
    df = spark.createDataFrame(
        rows, "date date, measure string, seasonally_adjusted boolean, value double"
    ).withColumn("publication_date", F.date_add(F.last_day("date"), 10))
    row = E.national_features(df, "2023-07-15").first()
    assert row.national_data_month == "2023-06-01"
    assert row.cpi_yoy == pytest.approx(1.002**12 - 1)
    assert row.cpi_3m_annualized == pytest.approx(1.002**12 - 1)
    assert row.payroll_growth_12m == pytest.approx(1029 / 1017 - 1)
    assert row.real_wage_growth_12m == pytest.approx(1.004**12 / 1.002**12 - 1)
    assert row.national_unemployment_rate is None


def test_population_and_density(spark):
    rows = [
        ("ME", 2018, 1.30, "2019", "2019-12-31"), ("ME", 2019, 1.31, "2022", "2022-12-31"),
        ("ME", 2020, 1.34, "2022", "2022-12-31"), ("ME", 2021, 1.35, "2022", "2022-12-31"),
        ("ME", 2022, 1.38, "2022", "2022-12-31"), ("ME", 2022, 1.40, "2023", "2023-12-31"),
    ]
    df = days(
        spark.createDataFrame(
            rows,
            "state string, year int, population double, revision_vintage string, "
            "publication_date string",
        ),
        "publication_date",
    )
    people = D.population_as_of(df, "2023-06-01")
    row = people.first()
    assert (row.population_year, row.population, row.population_vintage) == (2022, 1.38, "2022")
    assert row.population_growth_4y == pytest.approx(1.38 / 1.30 - 1)  # row by row, any vintage
    assert row.population_growth_10y is None
    land = spark.createDataFrame([("ME", 2020, 30.0)], "state string, year int, land_area_sq_miles double")
    land = land.withColumn("publication_date", F.lit(dt.date(2020, 12, 31)))
    dense = D.density_features(people, land, "2023-06-01").first()
    assert dense.log_population_density == pytest.approx(math.log1p(1.38 / 30))


def candidates(spark):
    rows = [
        ("a", "DEM", "NC", "I", "C", 2022), ("b", "REP", "NC", "C", None, 2022),
        ("c", "REP", "VA", "O", "C", 2022), ("d", "LIB", "VA", None, "N", None),
        ("e", "DEM", "VA", "I", "C", 2026), ("f", "DEM", "VA", "I", "P", 2022),
    ]
    df = spark.createDataFrame(
        rows,
        "candidate_id string, party string, state string, incumbent_challenger_status string, "
        "candidate_status string, election_year int",
    )
    return df.select(
        "*", F.lit(2022).alias("cycle"), F.lit("senate").alias("office"),
        F.lit("statewide").alias("district"), F.lit(dt.date(2022, 6, 30)).alias("publication_date"),
    )


def test_incumbency(spark):
    rows = {r.state: r for r in C.incumbency_features(candidates(spark), 2022, "senate", "2022-10-01").collect()}
    assert rows["NC"].incumbent_party == "DEM" and rows["NC"].dem_incumbent
    assert not rows["NC"].open_seat and rows["NC"].n_rep_candidates == 1
    assert rows["VA"].open_seat and rows["VA"].incumbent_party is None
    assert rows["VA"].dem_incumbent is False  # false, not unknown
    assert C.incumbency_features(candidates(spark), 2022, "senate", "2022-06-29").count() == 0


def test_finance_needs_a_snapshot_from_before(spark):
    rows = [
        ("a", "DEM", 60.0, "2022-09-30", "2022-10-12"), ("b", "REP", 20.0, "2022-09-30", "2022-10-12"),
        ("c", "REP", 10.0, "2022-09-30", "2022-10-12"), ("a", "DEM", 50.0, "2022-06-30", "2022-10-12"),
        ("a", "DEM", 99.0, "2022-12-31", "2023-01-20"),
    ]
    df = spark.createDataFrame(
        rows,
        "candidate_id string, party string, total_receipts double, coverage_end_date string, "
        "retrieval_date string",
    )
    df = days(df, "coverage_end_date", "retrieval_date").select(
        "*", F.lit(2022).alias("cycle"), F.lit("senate").alias("office"), F.lit("GA").alias("state"),
        F.col("total_receipts").alias("total_disbursements"), F.lit(1.0).alias("cash_on_hand_end"),
        F.lit(2.0).alias("individual_contributions"), F.lit("x").alias("revision_vintage"),
        F.date_add("coverage_end_date", 10).alias("publication_date"),
    )
    row = C.finance_features(df, 2022, "senate", "2022-10-15").first()
    assert (row.dem_receipts, row.rep_receipts) == (60.0, 20.0)
    assert row.dem_fundraising_share == 0.75 and row.finance_rep_candidate_id == "b"
    assert row.log_dem_receipts == pytest.approx(math.log1p(60))
    assert C.finance_features(df, 2022, "senate", "2022-10-11").count() == 0
    only = C.finance_features(df.where("party = 'DEM'"), 2022, "senate", "2022-10-15").first()
    assert only.rep_receipts == 0.0 and only.finance_rep_candidate_id is None


def polls(spark):
    rows = [
        ("1", "WI", "2022-09-30", "2022-10-01", 600.0, 0.02), ("2", "WI", "2022-10-08", "2022-10-09", None, 0.05),
        ("3", "WI", "2022-10-12", "2022-10-13", 1000.0, 0.01), ("4", "WI", "2022-10-14", "2022-10-20", 900.0, -0.5),
        ("5", "OH", "2022-07-01", "2022-07-02", 500.0, 0.10), ("6", "OH", "2022-07-05", "2022-07-06", 500.0, 0.20),
        ("7", "OH", "2022-07-07", "2022-07-08", 500.0, 0.30), ("8", "OH", "2022-06-01", "2022-06-02", 500.0, 0.90),
    ]
    df = spark.createDataFrame(
        rows,
        "poll_id string, state string, end_date string, publication_date string, "
        "sample_size double, poll_margin double",
    )
    return days(df, "end_date", "publication_date").select(
        "*", F.lit("senate").alias("office"), F.lit("statewide").alias("district"),
        F.lit(2022).alias("year"), (0.45 + F.col("poll_margin")).alias("dem_pct"),
        F.lit(0.45).alias("rep_pct"),
    )


def test_race_polls(spark):
    rows = {
        r.state: r
        for r in P.race_poll_features(polls(spark), 2022, "senate", "2022-10-15", "2022-11-08").collect()
    }
    wi = rows["WI"]
    # The missing sample size counts as the median of the others, 800.
    expected = (600 * 0.02 + 800 * 0.05 + 1000 * 0.01) / 2400
    assert wi.number_recent_polls == 3 and wi.state_poll_margin == pytest.approx(expected)
    assert wi.poll_recency_days == 3 and wi.days_to_election == 24
    # Seven days back from October 15 is October 8, which no longer counts.
    assert wi.polling_average_7d == pytest.approx(0.01)
    oh = rows["OH"]  # no poll within 30 days: the last three count
    assert oh.number_recent_polls == 0 and oh.state_poll_margin == pytest.approx(0.2)
    assert oh.polling_average_30d is None and oh.polling_uncertainty is None


def test_approval(spark):
    df = days(
        spark.createDataFrame(
            [("2022-10-10", "2022-10-11", 0.4, 0), ("2022-10-01", "2022-10-02", None, 500), ("2022-09-10", "2022-09-12", 0.5, 700)],
            "end_date string, publication_date string, approve double, sample_size int",
        ),
        "end_date", "publication_date",
    ).withColumn("net_approval", F.col("approve") - 0.5)
    row = P.approval_features(df, "2022-10-15").first()
    assert row.n_approval_polls_30d == 2 and row.approval_average_30d == pytest.approx(0.4)
    assert row.approval_average_7d == pytest.approx(0.4)
    assert row.approval_change_30d == pytest.approx(-0.1)
    assert P.approval_features(df, "2022-01-01").first().approval_average_30d is None


def test_special_swing(spark):
    df = days(
        spark.createDataFrame(
            [("2022-10-01", 0.1), ("2022-08-01", 0.3)], "election_date string, special_election_swing double"
        ),
        "election_date",
    ).withColumn("publication_date", F.col("election_date"))
    row = P.special_election_swing(df, "2022-10-15").first()
    assert row.special_election_swing_30d == 0.1
    assert row.special_election_swing_90d == pytest.approx(0.2)
