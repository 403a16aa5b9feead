"""Corpus pipeline: classify, apply rules, drop near-duplicates, mix sources, encode.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
applies them in turn to the documents, each result written as Parquet under
the folder in spark.checkpoint.dir and read again.  A stage's table is removed
when the next one has been written; the last one stays, since ``run`` returns
what is read from it.

All stages read whole texts of any length, take rows as they come (rows of one
id and text count as often as they occur unless said otherwise), keep further
columns under their own names up to the last stage, and give an empty result
for an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lociframe import scratch
from lociframe.llm import op1_quality, op3_join, op5_rules, op8_mix, op9_bpe


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores at one half or more.

    Null and empty texts score as a text without tokens; equal texts score
    alike; a score of exactly one half stays, so without labels all rows stay.
    Nulls in other columns change nothing.
    """
    return op1_quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.

    Null, empty and short texts (fewer than 20 words) go; a null or unknown
    lang is judged by the general references; equal rows fare alike; a distance
    equal to its limit stays.
    """
    return op5_rules.filtered(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity of 0.8 or more).

    The least doc_id stays, null last; repeated rows are one document; texts
    without words (null, empty, blank) are linked with nothing and all stay.
    """
    return op3_join.one_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mixture takes them, in order of their finish times.

    A null source is a source of its own, the last; texts without words take
    nothing but may be among what is taken; documents that finish at the same
    time are taken together.
    """
    return op8_mix.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token ids, their number and digest, and the digest of the text decoded from them.

    A null text encodes as the empty one; a null doc_id stays null; further
    columns are not returned.
    """
    return op9_bpe.encode_texts(docs, ["doc_id"])


STAGES = [("classify", classify), ("rules", rules), ("near_duplicates", near_duplicates), ("mix", mix), ("encode", encode)]

#: The classifier and the encoder cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, from the documents table to the encoded mixture."""
    folder = scratch.fresh(spark, "pipeline")
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            scratch.remove(spark, before)
        before = f"{folder}/{name}"
    return docs
