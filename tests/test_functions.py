import datetime as dt

import pytest
from pyspark.sql import functions as F

from hustings.functions import dates as DT
from hustings.functions import geo
from hustings.functions import scalars as S
from hustings.functions.parties import normalize_party


def values(spark, items, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}")
    return [r.o for r in df.select("i", expr(F.col("v")).alias("o")).orderBy("i").collect()]


def test_states(spark):
    items = ["Ohio", "oh", "39", "  new   mexico ", "D.C.", "US Virgin Islands", "6", "0", "Narnia", None, "", "USA"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], "i int, v string")
    got = geo.add_state_columns(df, "v").orderBy("i").collect()
    assert [r.state for r in got] == ["OH", "OH", "OH", "NM", "DC", "VI", "CA", None, None, None, None, None]
    assert got[3].state_fips == "35" and got[3].state_name == "New Mexico"
    national = geo.add_state_columns(df, "v", allow_national=True).where("i = 11").first()
    assert national.state == "US" and national.state_fips is None
    assert geo.add_state_columns(df, "v", drop_unmapped=True).count() == 7
    numbers = spark.createDataFrame([(42.0,), (1.0,), (None,)], "v double")
    assert [r.state for r in geo.add_state_columns(numbers, "v").collect()] == ["PA", "AL", None]
    assert values(spark, items, geo.is_valid_state) == [True] * 7 + [False] * 5


def test_state_dimension(spark):
    assert geo.states_frame(spark).count() == 51
    every = geo.states_frame(spark, include_territories=True)
    assert every.count() == 56 and every.select("state_fips").distinct().count() == 56
    assert every.where("is_state").count() == 50


@pytest.mark.parametrize(
    ("label", "party"),
    [
        ("DEMOCRAT", "DEM"), (" democratic-farmer-labor ", "DEM"), ("Democratic  Party", "DEM"),
        ("DEMOCRAT (WRITE-IN)", "DEM"), ("DFL", "DEM"), ("Republican", "REP"), ("REPUBLICANS UNITED", "REP"),
        ("Libertarian", "LIB"), ("LIBERTARIANS", "LIB"), ("GRE", "GRN"), ("DESERT GREEN PARTY", "GRN"),
        ("GREENBACK", "OTHER"), ("INDEPENDENT", "IND"), ("NO PARTY PREFERENCE", "IND"),
        ("INDEPENDENT AMERICAN", "OTHER"), ("UNK", "OTHER"), ("", "OTHER"), (None, "OTHER"),
    ],
)
def test_parties(spark, label, party):
    assert values(spark, [label], normalize_party) == [party]


@pytest.mark.parametrize(
    ("year", "day"),
    [(2016, 8), (2018, 6), (2020, 3), (2021, 2), (2022, 8), (2024, 5), (1988, 8)],
)
def test_election_day(spark, year, day):
    assert DT.election_day(year) == dt.date(year, 11, day)
    assert values(spark, [year], DT.general_election_date, "int") == [dt.date(year, 11, day)]


def test_periods(spark):
    got = values(spark, ["M01", "M12", "M13", "Q02", "Q05", "A01", "S01", None], lambda c: DT.bls_period_to_date(F.lit("2023"), c))
    d = dt.date
    assert got == [d(2023, 1, 1), d(2023, 12, 1), None, d(2023, 4, 1), None, d(2023, 1, 1), None, None]


def test_parse_date(spark):
    items = ["2024-03-05", "3/5/2024", "20240305", "March 5, 2024", "2024-03-05 10:00:00", "05|03|2024", "x", "", None]
    got = values(spark, items, lambda c: DT.parse_date(c, ("dd|MM|yyyy",)))
    assert got == [dt.date(2024, 3, 5)] * 6 + [None] * 3


def test_numbers(spark):
    assert values(spark, ["1.5", " 2 ", "x", "", "NaN", None], S.to_double) == [1.5, 2.0, None, None, None, None]
    assert values(spark, ["0.5", "1.5", "2.5", "x"], S.to_long) == [0, 2, 2, None]
    assert values(spark, ["Yes", " t ", "0", "no", None], S.to_bool) == [True, True, False, False, None]
    assert values(spark, ["45", "0.45", "1", None], S.share) == [0.45, 0.45, 1.0, None]
    assert values(spark, ["-", " 5 ", None], S.dash_to_null) == [None, 5.0, None]
    assert values(spark, [-99.0, 0.0, 3.0], S.negative_to_null, "double") == [None, 0.0, 3.0]
    assert values(spark, [0.0, 2.0], lambda c: S.ratio(F.lit(1.0), c), "double") == [None, 0.5]


def test_districts(spark):
    items = ["0", "7", "12", "07", "statewide", "", None, "3.0", "AL"]
    assert values(spark, items, S.district_label) == [
        "at-large", "07", "12", "07", "statewide", "statewide", "statewide", "03", "al",
    ]
