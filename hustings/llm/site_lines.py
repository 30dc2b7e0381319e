"""Line dedup by site-relative frequency.

A line is boilerplate of a host when the pages of the host that contain it are
more than ``ratio`` of all its pages and at least ``least`` pages. Boilerplate
lines are dropped from the host's pages; other hosts keep theirs.

Pages are counted per (host, line) with partial sums below the shuffle, so a
hot host or line sends one row per task. Only the numbers of pages and lines
travel: a line is its 128-bit hash. The lines of pages are joined with the
boilerplate lines by (host, line) as a plain equi-join, whose hot keys adaptive
execution splits; then each page gathers the lines to drop, at most its own.

Cases: a null url, or one without a host, is the host NULL, which has no site
and keeps all lines. A null page text has no lines and stays NULL. Empty lines
are kept and never counted. Repeated pages (same id) each count as a page, and
each is stripped. Extra columns pass through, but for names of added ones, in any case, which
are refused.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, materialize

RATIO = 0.3
#: The least number of pages at which a line repeats.
LEAST = 2
#: A new line begins at these tags; all other tags go.
BLOCKS = "(?i)<(br|p|/p|li|/li|div|/div|h[1-6]|/h[1-6]|tr|/tr|title|/title|nav|article|footer|header)[^>]*>"
#: An element or comment that never ends takes the rest of the page, so a page is read once, however many there are.
HIDDEN = r"(?is)<script.*?(?:</script>|\z)|<style.*?(?:</style>|\z)|<!--.*?(?:-->|\z)"


def host_of(url: Column) -> Column:
    """Lower-cased host of a URL; NULL without one."""
    host = F.lower(F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)", 1))
    return F.when(host != "", host)


def text_of(html: Column) -> Column:
    """Visible text of a page, one line per block."""
    text = F.regexp_replace(html, HIDDEN, "\n")
    text = F.regexp_replace(text, BLOCKS, "\n")
    return F.regexp_replace(text, "<[^>]*>", "")


def lines_of(text: Column) -> Column:
    """Lines without spaces around them."""
    return F.transform(F.split(text, "\n"), lambda x: F.trim(x))


def _key(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(line, F.lit(1)).alias("b"))


def boilerplate(pages: DataFrame, ratio: float = RATIO, least: int = LEAST) -> DataFrame:
    """(host, line key, n_pages, host_pages) of boilerplate lines. ``pages``: host, lines."""
    sited = pages.where("host is not null")
    totals = sited.groupBy("host").agg(F.count(F.lit(1)).alias("host_pages"))
    counts = (
        sited.select("host", F.explode(F.array_distinct(F.filter("lines", lambda x: x != ""))).alias("line"))
        .select("host", _key(F.col("line")).alias("key"))
        .groupBy("host", "key")
        .agg(F.count(F.lit(1)).alias("n_pages"))
        .where(F.col("n_pages") >= least)
    )
    return counts.join(totals, "host").where(F.col("n_pages") > ratio * F.col("host_pages"))


def strip(
    pages: DataFrame,
    url_col: str = "url",
    text_col: str = "html",
    ratio: float = RATIO,
    least: int = LEAST,
    is_html: bool = True,
) -> DataFrame:
    """``pages`` with ``host``, ``text`` (lines kept), ``n_lines`` and ``n_dropped`` added."""
    row = free_name(pages, "row")
    given = {c.lower() for c in pages.columns} - ({text_col.lower()} if is_html else set())
    clash = {"host", "text", "n_lines", "n_dropped"} & given
    if clash:
        raise ValueError(f"columns exist already: {sorted(clash)}; select or rename")
    text = F.col(f"`{text_col}`")
    # Stored once: page numbers must not change between the passes over it.
    read = materialize(
        pages.withColumns(
            {
                "host": host_of(F.col(f"`{url_col}`")),
                "lines": lines_of(text_of(text) if is_html else text),
                row: F.monotonically_increasing_id(),
            }
        ).drop(*([text_col] if is_html else [])),
        "lines",
    )
    drop = materialize(boilerplate(read, ratio, least).select("host", "key"), "boilerplate")
    found = (
        read.where("host is not null")
        .select(row, "host", F.explode(F.array_distinct(F.filter("lines", lambda x: x != ""))).alias("line"))
        .select(row, "host", _key(F.col("line")).alias("key"))
        .join(drop, ["host", "key"])
        .groupBy(row)
        .agg(F.collect_set("key").alias("keys"))
    )
    kept = F.when(
        F.col("keys").isNull(), F.col("lines")
    ).otherwise(F.filter("lines", lambda x: (x == "") | ~F.array_contains("keys", _key(x))))
    return (
        read.join(found, row, "left")
        .withColumn("kept", kept)
        .withColumns(
            {
                "text": F.array_join("kept", "\n"),
                "n_lines": F.coalesce(F.size("lines"), F.lit(0)),
                "n_dropped": F.coalesce(F.size("lines") - F.size("kept"), F.lit(0)),
            }
        )
        .drop(row, "lines", "kept", "keys")
    )


def digest(pages: DataFrame) -> DataFrame:
    """Every page: its host, the lines it had, the lines dropped and the text kept."""
    return strip(pages.select("page_id", "url", "html")).drop("url")


_TEXT = f"""regexp_replace(regexp_replace(regexp_replace(html, '{HIDDEN}', chr(10), 'g'),
  '{BLOCKS}', chr(10), 'g'), '<[^>]*>', '', 'g')"""

ORACLE = f"""
with p as (
  select page_id, row_number() over () as r,
    nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)', 1)), '') as host,
    list_transform(string_split({_TEXT}, chr(10)), lambda x: trim(x)) as lines
  from pages
), hosts as (select host, count(*) as host_pages from p where host is not null group by host
), seen as (
  select host, line, count(*) as n_pages
  from (select r, host, unnest(list_distinct(lines)) as line from p where host is not null)
  where line <> '' group by host, line
), used as (
  select host, line from seen join hosts using (host)
  where n_pages >= {LEAST} and n_pages > {RATIO} * host_pages
), each as (
  select r, p.host, unnest(range(1, len(lines) + 1)) as i, unnest(lines) as line from p
), left_lines as (
  select r, string_agg(line, chr(10) order by i) as text, count(*) as n
  from each e where not exists (select 1 from used u where u.host = e.host and u.line = e.line) group by r
)
select page_id, p.host, case when lines is null then null else coalesce(text, '') end as text,
  cast(coalesce(len(lines), 0) as integer) as n_lines,
  cast(coalesce(len(lines), 0) - coalesce(n, 0) as integer) as n_dropped
from p left join left_lines using (r)
"""
