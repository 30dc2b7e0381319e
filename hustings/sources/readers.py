"""Readers of landed source files. Values stay text; typing comes later, in the
normalizers, so that one bad cell never fails a load."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import (
    AuthenticationError,
    DatasetUnavailableError,
    ParserError,
    SchemaChangeError,
)
from ..functions.dates import bls_period_to_date
from ..functions.scalars import dash_to_null

LATIN_1 = "ISO-8859-1"


def require_columns(df: DataFrame, needed: Sequence[str], what: str) -> None:
    """Fail when the upstream layout has changed."""
    missing = sorted(set(needed) - set(df.columns))
    if missing:
        raise SchemaChangeError(f"{what} lacks columns {missing}")


def require_rows(df: DataFrame, ok: Column, message: str) -> DataFrame:
    """Let rows pass, failing the job at the first one that is not ``ok``. The
    test runs inside the tasks: no extra pass, nothing brought to the driver."""
    failure = F.raise_error(F.lit(message)).cast("boolean")
    return df.where(F.when(F.coalesce(ok, F.lit(False)), F.lit(True)).otherwise(failure))


def _text_csv(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    df = spark.read.options(
        header=True, inferSchema=False, quote='"', escape='"', **options
    ).csv(path)
    named = df.toDF(*[c.strip().lstrip("﻿") for c in df.columns])
    return named.select([F.nullif(F.col(f"`{c}`"), F.lit("")).alias(c) for c in named.columns])


def read_returns_file(spark: SparkSession, path: str) -> DataFrame:
    """Election returns, comma- or tab-separated: whichever the header has more of."""
    header = spark.read.text(path).first()
    if header is None:
        raise ParserError(f"{path} is empty")
    tabs, commas = header.value.count("\t"), header.value.count(",")
    return _text_csv(spark, path, sep="\t" if tabs > commas else ",")


def read_latin_csv(spark: SparkSession, path: str) -> DataFrame:
    return _text_csv(spark, path, encoding=LATIN_1)


def read_gazetteer(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated; header names carry padding."""
    return _text_csv(
        spark, path, sep="\t", encoding=LATIN_1,
        ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True,
    )


def read_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Plain comma-separated text (county, turnout and industry files)."""
    return _text_csv(spark, path)


def with_file_year(df: DataFrame, pattern: str = r"(?<!\d)((?:19|20)\d{2})(?!\d)") -> DataFrame:
    """Add ``year`` from the path of the file a row came from: the last year in it, be
    it in the file's name or in a folder's, as where Spark wrote the files."""
    found = F.regexp_extract_all(F.input_file_name(), F.lit(pattern), F.lit(1))
    return df.withColumn("year", F.try_element_at(found, F.lit(-1)).try_cast("bigint"))


def read_laus_flat_file(spark: SparkSession, path: str) -> DataFrame:
    """Padded tab-separated series file; monthly rows only."""
    df = _text_csv(
        spark, path, sep="\t", ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True
    )
    require_columns(df, ("series_id", "year", "period", "value"), "series flat file")
    monthly = df.where(F.col("period").startswith("M") & (F.col("period") != "M13"))
    return monthly.select(
        F.trim("series_id").alias("series_id"),
        bls_period_to_date("year", "period").alias("date"),
        dash_to_null("value").alias("value"),
    )


def read_pipe_file(spark: SparkSession, path: str, layout: Sequence[str]) -> DataFrame:
    """Pipe-separated file without header or quoting. A line with another number
    of fields than the layout fails the job that reads it."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*layout, "_bad")])
    df = spark.read.options(
        sep="|", quote="", encoding=LATIN_1, mode="PERMISSIVE", columnNameOfCorruptRecord="_bad"
    ).schema(schema).csv(path)
    message = f"expected {len(layout)} pipe-separated fields"
    checked = require_rows(df, F.col("_bad").isNull(), message)
    return checked.select([F.nullif(F.col(c), F.lit("")).alias(c) for c in layout])


def read_manual_csvs(spark: SparkSession, directory: str) -> DataFrame:
    """Union by name of hand-placed CSV files, whose headers may differ: one scan per
    different header. Only file names and headers come to the driver; of each file
    no more than its beginning is read for that, however long it is."""
    paths = sorted(spark.read.option("pathGlobFilter", "*.csv").text(directory).inputFiles())
    first = [spark.read.text(p).limit(1).select(F.lit(p).alias("path"), F.col("value").alias("header")) for p in paths]
    headers = reduce(DataFrame.unionByName, first).collect() if first else []
    if not headers:
        raise ParserError(f"no CSV files in {directory}")
    alike: dict[str, list[str]] = {}
    for row in sorted(headers):
        alike.setdefault(row.header, []).append(row.path)
    scans = [read_csv(spark, paths) for _, paths in sorted(alike.items(), key=lambda x: x[1][0])]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


# ------------------------------------------------------------------------ JSON


def response_problem(body: Column | str) -> Column:
    """What is wrong with an API response body: ``auth``, ``schema``, ``empty``,
    ``parse`` or NULL. Pages of the keyed API answer errors as HTML."""
    text = F.col(body) if isinstance(body, str) else body
    start = F.regexp_replace(text, r"^\s+", "")
    title = F.regexp_extract(text, r"(?is)<title>(.*?)</title>", 1)
    document = F.try_parse_json(text)
    return (
        F.when(start.isNull() | (start == ""), F.lit("empty"))
        .when(
            start.startswith("<"),
            F.when(title.rlike(r"(?i)invalid key|missing key"), F.lit("auth")).otherwise(
                F.lit("schema")
            ),
        )
        .when(document.isNull(), F.lit("parse"))
    )


_PROBLEMS = {
    "auth": AuthenticationError,
    "schema": SchemaChangeError,
    "empty": DatasetUnavailableError,
    "parse": ParserError,
}


def check_responses(bodies: DataFrame, column: str = "value") -> DataFrame:
    """The bodies, or the error of the first bad one."""
    bad = bodies.select(response_problem(column).alias("p")).where("p is not null").first()
    if bad is not None:
        raise _PROBLEMS[bad.p](f"landed API response is unusable ({bad.p})")
    return bodies


def whole_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: ``value`` and ``file``."""
    return spark.read.text(path, wholetext=True).select(
        "value", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file")
    )


def parse_acs_cells(bodies: DataFrame) -> DataFrame:
    """Responses that are arrays of rows (the first one the header) as cells:
    file, row_no, variable, value."""
    rows = bodies.select(
        "file", F.from_json("value", "array<array<string>>").alias("rows")
    )
    cells = rows.select(
        "file",
        F.element_at("rows", 1).alias("header"),
        F.posexplode(F.expr("slice(rows, 2, greatest(size(rows) - 1, 0))")).alias("row_no", "cells"),
    )
    return cells.select(
        "file", "row_no", F.explode(F.arrays_zip("header", "cells")).alias("c")
    ).select("file", "row_no", F.col("c.header").alias("variable"), F.col("c.cells").alias("value"))


SERIES_SCHEMA = (
    "status string, Results struct<series: array<struct<seriesID: string, data: array<struct<"
    "year: string, period: string, periodName: string, value: string, "
    "footnotes: array<struct<text: string>>>>>>>"
)


def _parsed(bodies: DataFrame, schema: str) -> DataFrame:
    return bodies.select(F.from_json("value", schema).alias("j")).select("j.*")


def parse_series(bodies: DataFrame) -> DataFrame:
    """Series responses, one row per observation; yearly averages are left out."""
    series = _parsed(bodies, SERIES_SCHEMA).select(F.explode("Results.series").alias("s"))
    return series_observations(series.select("s.seriesID", "s.data"))


def read_series_json(spark: SparkSession, path: str) -> DataFrame:
    return parse_series(whole_files(spark, path))


def series_observations(series: DataFrame) -> DataFrame:
    rows = series.select(F.col("seriesID").alias("series_id"), F.explode("data").alias("o"))
    notes = F.filter(F.transform("o.footnotes", lambda f: f["text"]), lambda x: x.isNotNull())
    return rows.select(
        "series_id",
        bls_period_to_date("o.year", "o.period").alias("date"),
        dash_to_null("o.value").alias("value"),
        F.array_join(notes, ";").alias("footnotes"),
    ).where(F.col("date").isNotNull())


ACCOUNTS_SCHEMA = (
    "BEAAPI struct<Error: string, Results: struct<Error: string, Data: array<struct<"
    "Code: string, GeoFips: string, GeoName: string, TimePeriod: string, CL_UNIT: string, "
    "UNIT_MULT: string, DataValue: string>>>>"
)


def read_accounts_json(spark: SparkSession, path: str) -> DataFrame:
    return parse_accounts(whole_files(spark, path))


def parse_accounts(bodies: DataFrame) -> DataFrame:
    """State account responses; an error anywhere in one fails the job."""
    api = _parsed(bodies, ACCOUNTS_SCHEMA).select("BEAAPI.*")
    fine = F.col("Error").isNull() & F.col("Results.Error").isNull()
    checked = require_rows(api, fine & F.col("Results.Data").isNotNull(), "accounts API error")
    return checked.select(F.explode("Results.Data").alias("d")).select("d.*")


SCORES_SCHEMA = (
    "status int, result array<struct<year: int, stattype: string, subject: string, grade: int, "
    "jurisdiction: string, value: double, isStatDisplayable: int, errorFlag: int>>"
)


def read_scores_json(spark: SparkSession, path: str) -> DataFrame:
    return parse_scores(whole_files(spark, path))


def parse_scores(bodies: DataFrame) -> DataFrame:
    """Assessment responses; an empty result is an empty frame."""
    api = _parsed(bodies, SCORES_SCHEMA)
    fine = (F.col("status") == 200) & F.col("result").isNotNull()
    checked = require_rows(api, fine, "assessment response is not OK")
    return checked.select(F.explode("result").alias("r")).select("r.*")
