"""Registered queries of the text operators and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gearwatch.llm import (bottom_k, bpe_lexicon, induced_sorting, laesa, language_ftrl, license_join, oracle, parity_join, permuterm, pfair_mix,
                           quality_cascade, style_tree, suffix_trees, url_markov)
from gearwatch.llm.common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql:
            SQL[name] = sql
        return function
    return register


@query("op1_quality_rules", oracle.QUALITY)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return quality_cascade.judge(documents(spark, folder))


@query("op2_url_filters")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return url_markov.judge(spark.read.parquet(f"{folder}/pages.parquet"))


@query("op10_document_fingerprints")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return bottom_k.report(documents(spark, folder))


@query("op9_mixing_sources", oracle.MIXING)
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return pfair_mix.report(documents(spark, folder))


@query("op8_license_scans", oracle.licenses(license_join.TEMPLATES, license_join.PHRASES))
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return license_join.scan(documents(spark, folder))


@query("op5_language_id")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return language_ftrl.identify(documents(spark, folder))


@query("op4_bpe_tokens")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return bpe_lexicon.digests(documents(spark, folder), tokenizer_path())


@query("op6_suffix_array_dedup", oracle.BYTES)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return induced_sorting.report(documents(spark, folder))


@query("op7_substring_dedup", oracle.PASSAGES)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_trees.report(documents(spark, folder))


@query("op3_ngram_jaccard_join", oracle.JACCARD)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return parity_join.report(documents(spark, folder), shingle=4, percent=85)


@query("op11_centroid_clustering", oracle.clusters())
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return laesa.report(spark.read.parquet(f"{folder}/embeddings.parquet"))


@query("op12_spelling_variants", oracle.VARIANTS)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return permuterm.report(documents(spark, folder))


@query("op13_html_extraction")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return style_tree.report(spark.read.parquet(f"{folder}/pages.parquet"))
