"""The named queries of the training-data operators, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tideframe.llm import bpe, fim, jaccard, langid, licences, pages, phrases, preferences, quality, rules, search, suffixes, templates

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op1_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op2_phrase_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.digests(table(spark, sf_dir, "documents"))


ORACLE["op2_phrase_dedup"] = phrases.ORACLE


@query
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digests(table(spark, sf_dir, "documents"))


@query
def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.report(table(spark, sf_dir, "documents"))


ORACLE["op7_ngram_jaccard"] = jaccard.ORACLE


@query
def op4_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


@query
def op3_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(table(spark, sf_dir, "pages"))


@query
def op5_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preferences.swapped_replies(table(spark, sf_dir, "conversations"))


ORACLE["op5_preference_pairs"] = preferences.ORACLE


@query
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


@query
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(table(spark, sf_dir, "documents"))


ORACLE["op13_fill_in_middle"] = fim.ORACLE


@query
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE["op11_ranked_search"] = search.ORACLE


@query
def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
