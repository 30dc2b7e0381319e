"""Registered queries of the text operators, with SQL where SQL can express them."""

from __future__ import annotations

from . import (
    class_lm,
    decontaminate,
    html_templates,
    language,
    merkle,
    mixing,
    periodic_runs,
    quality,
    set_join,
    sharding,
    site_lines,
    token_files,
    vector_search,
)
from .common import documents, table


def op1_class_lm(spark, sf_dir):
    return class_lm.digest(documents(spark, sf_dir))


def op2_decontamination(spark, sf_dir):
    return decontaminate.digest(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op3_top_k(spark, sf_dir):
    return vector_search.digest(table(spark, sf_dir, "embeddings"))


def op4_mixing(spark, sf_dir):
    return mixing.digest(documents(spark, sf_dir))


def op5_sharding(spark, sf_dir):
    return sharding.digest(documents(spark, sf_dir))


def op6_quality(spark, sf_dir):
    return quality.digest(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op7_token_files(spark, sf_dir):
    return token_files.digest(documents(spark, sf_dir))


def op8_site_lines(spark, sf_dir):
    return site_lines.digest(table(spark, sf_dir, "pages"))


def op9_language(spark, sf_dir):
    return language.digest(documents(spark, sf_dir))


def op10_set_join(spark, sf_dir):
    return set_join.digest(documents(spark, sf_dir))


def op11_html_extraction(spark, sf_dir):
    return html_templates.digest(table(spark, sf_dir, "pages"))


def op12_merkle_manifest(spark, sf_dir):
    return merkle.digest(documents(spark, sf_dir))


def op13_periodic_runs(spark, sf_dir):
    return periodic_runs.digest(documents(spark, sf_dir))


QUERIES = {
    f.__name__: f
    for f in (
        op1_class_lm,
        op2_decontamination,
        op3_top_k,
        op4_mixing,
        op5_sharding,
        op6_quality,
        op7_token_files,
        op8_site_lines,
        op9_language,
        op10_set_join,
        op11_html_extraction,
        op12_merkle_manifest,
        op13_periodic_runs,
    )
}
ORACLES = {
    "op2_decontamination": decontaminate.ORACLE,
    "op3_top_k": vector_search.ORACLE,
    "op8_site_lines": site_lines.ORACLE,
    "op11_html_extraction": html_templates.ORACLE,
    "op12_merkle_manifest": merkle.ORACLE,
}
