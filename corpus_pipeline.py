"""Cleaning a corpus in stages, each of which works on all that the one before kept.

A row is known by its doc_id and a hash of its text, so that null and repeated ids do no harm.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tideframe.llm import bpe, jaccard, quality, suffixes, templates
from tideframe.llm.common import quoted, written

#: Suffix sorting, templates and byte pairs are beyond SQL; tests/llm holds run() against a plain version.
ORACLE_SQL = None
_LAST = 2**63 - 1
#: Near copies have a similarity of 80 % or more by their shingles of 5 words; op7 has its own bar.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def _matched(docs: DataFrame, keys: DataFrame, how: str, once: bool = False) -> DataFrame:
    """Rows of docs with (left_semi) or without (left_anti) their doc_id and h in keys; once: one of those that agree in both.
    The columns of docs are in a struct meanwhile, so that none of their names can clash."""

    def known_by(h: Column) -> list[Column]:
        # plain columns: rows that the join has dealt out by them need not be dealt out again to be one of each
        return [F.col("doc_id").isNull().alias("none"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"), h.alias("h")]

    own = docs.select(F.struct(*map(quoted, docs.columns)).alias("row"), *known_by(F.xxhash64(F.coalesce("text", F.lit("")))))
    own = own.withColumn("void", F.col("row.text").isNull())
    found = own.join(keys.select(*known_by(F.col("h"))), ["none", "id", "h"], how)
    return (found.dropDuplicates(["none", "id", "h", "void"]) if once else found).select("row.*")


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    weights = quality.bucket_weights(docs, quality.trusted_ids(spark.read.parquet(f"{sf_dir}/labels.parquet")))
    # a row for each document kept, not a filter: that would be pushed down with all that `kept` is made of
    return quality.scored(docs, weights).select(F.explode(F.when(F.col("kept"), F.array("keep"))).alias("keep")).select("keep.*")


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by links of the Jaccard join, the one of the least id; all without a word."""
    found = jaccard.similar(docs, words=NEAR_WORDS, percent=NEAR_PERCENT).select("doc_id", "h", "root")
    first = found.filter("root IS NOT NULL").groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")).alias("one"))
    keep = first.select("one.doc_id", "one.h").unionByName(found.filter("root IS NULL").select("doc_id", "h"))
    return _matched(docs, keep, "left_semi", once=True)


def cut_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their repeated strings; a character of which a part goes becomes U+FFFD."""
    names = docs.columns
    rest = suffixes.remove_repeats(docs, carry=[c for c in names if c not in ("doc_id", "text", "n_chars")])
    text = F.make_valid_utf8(F.col("kept").cast("string"))
    columns = {"doc_id": F.col("doc_id"), "text": text, "n_chars": F.length(text).cast("long")}
    return rest.select(*[columns[c].alias(c) if c in columns else F.col("carry").getField(c).alias(c) for c in names])


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    leaks = templates.leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _matched(docs, leaks, "left_anti")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The number of each text's tokens, a digest of their ids and one of the bytes that they decode to."""
    return bpe.digests(spark, docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("quality rules", reject_low_quality),
    ("n-gram Jaccard join", one_of_near_copies),
    ("suffix-array dedup", cut_repeated_strings),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("byte-level BPE", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs)
    return docs
