"""A training-data pipeline over the table of documents: each stage works on what the one before kept.

``STAGES`` name functions from (spark, docs, sf_dir) to a DataFrame.  A stage's result is written as
Parquet and read again as the next one's ``docs``; all but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starmart.llm import language, mixing, secret_scan, simhash
from starmart.llm.registry import packed
from starmart.sources.scratch import stored

LEAST_SCORE = 0.3


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in a language of the labelled rows stay: null and letterless texts, and those
    that no language gets ``LEAST_SCORE`` for, go."""
    return language.accepted(docs, language.train(docs), LEAST_SCORE)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (fingerprints as in query op3 that reach each other in steps of
    at most two bits) the row with the least id stays."""
    return simhash.keep_one(docs)


def masked_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows stay; secrets in their texts are masked."""
    return secret_scan.masked(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of sources that have too little weight are repeated; none is left out."""
    return mixing.mixed(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows, packed: as query op2 returns them."""
    return packed(docs)


STAGES = [
    ("language", known_language),
    ("near_copies", one_of_near_copies),
    ("secrets", masked_secrets),
    ("mixing", mixed_sources),
    ("packing", packed_sequences),
]

# Networks, hashes and token merges are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
