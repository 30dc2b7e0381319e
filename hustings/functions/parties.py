"""Party labels of every source mapped onto six canonical codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import clean_token

CANONICAL_PARTIES = ("DEM", "REP", "LIB", "GRN", "IND", "OTHER")

# Source labels and codes with one meaning, by canonical party.
EXACT_LABELS: dict[str, tuple[str, ...]] = {
    "DEM": (
        "DEMOCRAT", "DEMOCRATIC", "DEMOCRATIC PARTY", "DEMOCRATIC-FARMER-LABOR",
        "DEMOCRATIC-NONPARTISAN LEAGUE", "DEMOCRATIC-NPL", "DEM", "DFL", "DNL",
    ),
    "REP": ("REPUBLICAN", "REPUBLICAN PARTY", "REP"),
    "LIB": ("LIBERTARIAN", "LIBERTARIAN PARTY", "LIB"),
    "GRN": ("GREEN", "GREEN PARTY", "PACIFIC GREEN", "GRE", "GRN"),
    "IND": (
        "INDEPENDENT", "INDEPENDENCE", "NONPARTISAN", "NO PARTY AFFILIATION",
        "NO PARTY PREFERENCE", "UNAFFILIATED", "UNENROLLED", "IND", "NPA", "NNE", "NON",
    ),
    "OTHER": ("UNK", "OTH", "OTHER"),
}


def normalize_party(label: Column | str) -> Column:
    """Exact labels first, then label families; unknown and missing are OTHER."""
    token = clean_token(label)
    expr = F.when(token.isNull(), F.lit("OTHER"))
    for party, labels in EXACT_LABELS.items():
        expr = expr.when(token.isin(*labels), F.lit(party))
    return (
        expr.when(token.startswith("DEMOCRAT"), F.lit("DEM"))
        .when(token.startswith("REPUBLICAN"), F.lit("REP"))
        .when(token.startswith("LIBERTARIAN"), F.lit("LIB"))
        .when(token.rlike(r"\bGREEN\b"), F.lit("GRN"))
        .otherwise(F.lit("OTHER"))
    )
