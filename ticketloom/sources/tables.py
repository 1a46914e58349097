"""Scans, sinks and schema checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

CORPUS_BASE = ["body", "answer", "type", "queue", "priority"]
CORPUS_OPTIONAL = ["subject", "version"]
CORPUS_DERIVED = [
    "clean_body", "clean_answer", "lemmatized_body",
    "body_length", "answer_length", "clean_answer_length",
]


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with line breaks inside quoted bodies; the schema is given, never inferred."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )


def write_csv(df: DataFrame, path: str) -> None:
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("quoteAll", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("emptyValue", "")
        .csv(path)
    )


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_report(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; found {df.columns}")
    return df


def columns_with_prefix(df: DataFrame, prefix: str = "tag_") -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def corpus_columns(df: DataFrame, key: Sequence[str] = ("ticket_id",)) -> DataFrame:
    """The corpus layout, in order, with whatever optional columns the table has."""
    wanted = [*key, *CORPUS_OPTIONAL, *CORPUS_BASE, *columns_with_prefix(df), *CORPUS_DERIVED]
    return df.select([c for c in wanted if c in df.columns])


def alignment_report(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Row counts of both sides and how many keys each has that the other lacks; one row.

    One full pass per side: rows of both are tagged, reduced per key and counted, so a key that
    repeats a billion times is still one row per task.
    """
    tagged = left.select(key, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(key, F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    per_key = tagged.groupBy(key).agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    return per_key.agg(
        F.coalesce(F.sum("l"), F.lit(0)).alias("left_rows"),
        F.coalesce(F.sum("r"), F.lit(0)).alias("right_rows"),
        F.count_if((F.col("r") == 0)).alias("only_left"),
        F.count_if((F.col("l") == 0)).alias("only_right"),
    )


def require_aligned(left: DataFrame, right: DataFrame, key: str) -> None:
    row = alignment_report(left, right, key).first()
    if row["only_left"] or row["only_right"] or row["left_rows"] != row["right_rows"]:
        raise ValueError(f"tables do not line up on {key}: {row.asDict()}")
