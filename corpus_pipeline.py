"""A pipeline from raw documents to token files.

Each stage takes ``(spark, docs, sf_dir)`` and returns a frame, which is written as
Parquet and read again as the next one's documents. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hustings.llm import decontaminate, language, mixing, set_join, token_files
from hustings.llm.common import documents, materialize, ship, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of some language; those without text or letters go."""
    ship(spark)
    return language.identified(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8 or more."""
    ship(spark)
    return set_join.deduplicated(docs, n=5, percent=80)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth stands in benchmark items."""
    return decontaminate.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources by weight; a document drawn twice stands twice."""
    ship(spark)
    return mixing.mixed(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, and what each document became in them."""
    ship(spark)
    return token_files.digest(docs)


STAGES = [
    ("language", identify_language),
    ("near_copies", drop_near_copies),
    ("benchmark", drop_benchmark),
    ("mixing", mix_sources),
    ("token_files", write_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs


#: SQL has no trie, no seeded draws and no tokenizer; the stages are tested against brute force.
ORACLE_SQL = None
