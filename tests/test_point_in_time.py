import datetime as dt

import pytest
from pyspark.sql import functions as F

from hustings.errors import PointInTimeError
from hustings.functions import calendar as cal
from hustings.functions.dates import cutoff
from hustings.operators import pit


@pytest.fixture(scope="module")
def vintages(spark):
    rows = [
        ("TX", 2020, 29.0, "2020", "2020-12-31"),
        ("TX", 2020, 29.2, "2021", "2021-12-31"),
        ("TX", 2021, 29.5, "2021", "2021-12-31"),
        ("TX", 2021, 29.6, "2022", "2022-12-31"),
        ("TX", 2022, 30.0, None, None),
        ("OK", 2020, 4.0, "2020", "2020-12-31"),
    ]
    df = spark.createDataFrame(
        rows, "state string, year int, population double, revision_vintage string, p string"
    )
    return df.withColumn("publication_date", F.col("p").cast("date")).drop("p")


def test_filter_as_of(vintages):
    assert pit.filter_as_of(vintages, None).count() == 6
    assert pit.filter_as_of(vintages, "2021-12-31").count() == 4
    assert pit.filter_as_of(vintages, dt.date(2021, 12, 30)).count() == 2
    assert pit.filter_as_of(vintages, "2021-12-31", keep_unknown=True).count() == 5


def test_filter_as_of_without_publication_column(vintages):
    bare = vintages.drop("publication_date")
    with pytest.raises(PointInTimeError):
        pit.filter_as_of(bare, "2021-12-31")
    assert pit.filter_as_of(bare, "2021-12-31", strict=False).count() == 6
    held = bare.withColumn("retrieval_date", F.lit(dt.date(2022, 1, 1)))
    assert pit.filter_as_of(held, "2021-12-31").count() == 0
    assert pit.filter_as_of(held, "2022-01-01").count() == 6


def test_resolve_publication_col(vintages):
    assert pit.resolve_publication_col(vintages) == "publication_date"
    unknown = vintages.withColumn("publication_date", F.lit(None).cast("date")).withColumn(
        "retrieval_date", F.lit(dt.date(2022, 1, 1))
    )
    assert pit.resolve_publication_col(unknown) == "retrieval_date"


def test_latest_as_of_uses_a_revision_only_once_published(vintages):
    def newest(day):
        rows = pit.latest_as_of(vintages, day, ["state"], order_col="year").collect()
        return {r.state: (r.year, r.population) for r in rows}

    assert newest("2021-06-01") == {"TX": (2020, 29.0), "OK": (2020, 4.0)}
    assert newest("2022-06-01") == {"TX": (2021, 29.5), "OK": (2020, 4.0)}
    assert newest("2023-06-01")["TX"] == (2021, 29.6)


def test_leakage(vintages):
    report = pit.leakage_report(vintages, "2021-12-31").first()
    assert (report.rows, report.rows_after_as_of, report.rows_unknown_publication) == (6, 1, 1)
    assert report.rows_available == 4 and report.max_publication_date == "2022-12-31"
    pit.assert_no_future_rows(vintages, "2022-12-31")
    with pytest.raises(PointInTimeError, match="1 rows"):
        pit.assert_no_future_rows(vintages, "2022-12-30")


def test_clip_estimated(spark):
    day = F.lit(dt.date(2024, 5, 1))
    held = F.lit(dt.date(2024, 4, 1))
    row = spark.range(1).select(
        pit.clip_estimated(day, F.lit(True), held).alias("a"),
        pit.clip_estimated(day, F.lit(False), held).alias("b"),
    ).first()
    assert row.a == dt.date(2024, 4, 1) and row.b == dt.date(2024, 5, 1)


def test_bad_dates():
    with pytest.raises(PointInTimeError):
        cutoff("soon")
    assert cutoff("2024-05-06") == dt.date(2024, 5, 6)


@pytest.mark.parametrize(
    ("rule", "value", "expected"),
    [
        ("month_end", dt.date(2024, 2, 1), dt.date(2024, 2, 29)),
        ("bls_laus_state", dt.date(2024, 8, 1), dt.date(2024, 9, 21)),
        ("bls_cpi", dt.date(2024, 8, 1), dt.date(2024, 9, 15)),
        ("bls_employment_situation", dt.date(2024, 8, 1), dt.date(2024, 9, 8)),
        ("fec_summary", dt.date(2024, 9, 30), dt.date(2024, 10, 20)),
        ("bls_qcew_annual", 2023, dt.date(2024, 6, 30)),
        ("acs_1year", 2023, dt.date(2024, 9, 30)),
        ("acs_5year", 2023, dt.date(2024, 12, 31)),
        ("pep_vintage", 2023, dt.date(2023, 12, 31)),
        ("census_geography", 2023, dt.date(2023, 12, 31)),
        ("urban_rural", 2020, dt.date(2022, 12, 31)),
        ("bea_annual", 2023, dt.date(2024, 9, 30)),
        ("bea_rpp", 2023, dt.date(2024, 12, 31)),
        ("naep", 2022, dt.date(2022, 12, 31)),
        ("naep", 2024, dt.date(2025, 6, 30)),
    ],
)
def test_release_rules(spark, rule, value, expected):
    row = spark.range(1).select(
        cal.apply_rule(rule, F.lit(value)).alias("day"),
        cal.apply_rule(rule, F.lit(None).cast("date" if isinstance(value, dt.date) else "int")).alias("none"),
    ).first()
    assert row.day == expected and row.none is None


def test_url_month_folder(spark):
    urls = [("/files/2023-06/a.zip",), ("/files/2024-02/b.zip",), ("/files/a.zip",), (None,)]
    got = spark.createDataFrame(urls, "u string").select(cal.from_url_month_folder("u").alias("d"))
    assert [r.d for r in got.collect()] == [dt.date(2023, 6, 30), dt.date(2024, 2, 29), None, None]
