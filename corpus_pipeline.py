"""From raw documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)``, works on everything its predecessor kept and returns a
DataFrame, which is written as Parquet and read again as the next stage's ``docs``.  All but the
last keep the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.llm import packing, personal_data, positional_index, quality_ranking, shingle_join
from ticketloom.llm.tables import documents, materialize
from ticketloom.sources.tables import read_table


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality ranking rejects go."""
    return quality_ranking.keep_good(docs, read_table(spark, sf_dir, "labels"), held_out_parts=5, cut=0.3)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents joined by near-duplicate links the one with the smallest id stays."""
    return shingle_join.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item go."""
    return positional_index.without_contaminated(docs, read_table(spark, sf_dir, "benchmark"), window=10)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data give way to their kind in brackets; ``n_chars`` follows the text."""
    hidden = personal_data.masked(docs)
    return hidden.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else hidden


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1, room=2048)


STAGES = [
    ("quality classifier", good_documents),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", decontaminated),
    ("PII", without_personal_data),
    ("packing", packed),
]

#: The classifier is fitted, and tokens come from a library: SQL has no counterpart for run()'s rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder before the next."""
    docs = documents(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES):
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{k}")
    return docs
