"""A training corpus from raw documents: five stages, each written and read again by the next.

A stage takes (spark, docs, sf_dir) and returns the columns of ``docs``; the last returns token ids. Stages work on all
rows that their predecessor kept, and accept nulls in any column, empty texts, repeated rows and empty tables as their
operators state it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passerine.llm import bpe, line_dedup, minhash, mixing, toxicity
from passerine.llm.shared import written


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays under the threshold."""
    return toxicity.reject(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that match an earlier line; those left without a word go."""
    cut = line_dedup.dedup(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cut


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return minhash.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's weight takes them."""
    return mixing.mix(docs, mixing.plan(docs)).select(*(F.col(f"`{c}`") for c in docs.columns))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with their digest and that of the text decoded from them."""
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("toxicity", without_toxic),
    ("line dedup", without_repeated_lines),
    ("near duplicates", without_near_duplicates),
    ("mixing", mixed),
    ("byte-level BPE", encoded),
]

#: Toxicity is a fitted model and tokens come from a library: no SQL. Tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs if not k else written(docs, f"pipeline-{k}"), sf_dir)
    return docs
