"""Ticket-shaped views over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ticketloom.scale import spread
from ticketloom.sources.tables import read_table


def tickets(spark: SparkSession, sf: str) -> DataFrame:
    """ticket_id, body, language, queue."""
    docs = read_table(spark, sf, "documents").select(
        F.col("doc_id").alias("ticket_id"),
        F.col("text").alias("body"),
        F.col("lang").alias("language"),
        F.col("source").alias("queue"),
    )
    return spread(docs, "ticket_id")


def attributes(spark: SparkSession, sf: str) -> DataFrame:
    """ticket_id, priority, type."""
    return read_table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("ticket_id"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderstatus").alias("type"),
    )


def tagged(spark: SparkSession, sf: str) -> DataFrame:
    """ticket_id, queue and three sparse tag columns."""
    size = F.col("p_size")
    return read_table(spark, sf, "part").select(
        F.col("p_partkey").alias("ticket_id"),
        F.col("p_type").alias("queue"),
        F.when(size % 10 != 0, F.col("p_brand")).alias("tag_1"),
        F.when(size % 2 == 0, F.col("p_type")).alias("tag_2"),
        F.when(size % 5 == 0, F.lower("p_brand")).alias("tag_3"),
    )


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    """ticket_id, embedding, queue."""
    return read_table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("ticket_id"), "embedding", F.col("label").cast("string").alias("queue")
    )


def answered(spark: SparkSession, sf: str) -> DataFrame:
    """ticket_id, conv_id, turn, subject, body, answer: a user turn and the reply that follows it."""
    turns = Window.partitionBy("conv_id").orderBy("turn")
    return (
        spread(read_table(spark, sf, "conversations"), "conv_id")
        .select(
            (F.col("conv_id") * 1000 + F.col("turn")).alias("ticket_id"),
            "conv_id",
            "turn",
            "role",
            F.col("text").alias("body"),
            F.lead("role").over(turns).alias("next_role"),
            F.lead("text").over(turns).alias("answer"),
        )
        .where((F.col("role") == "user") & (F.col("next_role") == "assistant"))
        .select(
            "ticket_id",
            "conv_id",
            "turn",
            F.when(F.col("turn") == 0, F.substring("body", 1, 40)).alias("subject"),
            "body",
            "answer",
        )
    )


def cases(spark: SparkSession, sf: str) -> DataFrame:
    """``answered`` with the queue its conversation belongs to."""
    queue_of = read_table(spark, sf, "documents").select(
        F.col("doc_id").alias("conv_id"), F.col("source").alias("queue")
    )
    # A conversation without a document has no queue and so is no case.
    return answered(spark, sf).join(queue_of, "conv_id", "inner").select(
        "ticket_id", "subject", "body", "answer", "queue"
    )


def full_tickets(spark: SparkSession, sf: str) -> DataFrame:
    """``answered`` with queue, language, type, priority and tags: every column a raw ticket can have."""
    queue_of = read_table(spark, sf, "documents").select(F.col("doc_id").alias("conv_id"), F.col("source").alias("queue"), F.col("lang").alias("language"))
    kinds = read_table(spark, sf, "orders").select(F.col("o_orderkey").alias("conv_id"), F.col("o_orderstatus").alias("type"), F.col("o_orderpriority").alias("priority"))
    labelled = tagged(spark, sf).select(F.col("ticket_id").alias("_part"), "tag_1", "tag_2", "tag_3")
    base = answered(spark, sf).withColumn("_part", F.col("conv_id") % 200 + 1)
    return base.join(queue_of, "conv_id", "left").join(kinds, "conv_id", "left").join(labelled, "_part", "left").drop("_part", "conv_id", "turn")


def replies(spark: SparkSession, sf: str) -> DataFrame:
    """ticket_id, raw: model replies, well-formed and broken in several ways."""
    kind = F.col("event_id") % 7
    queue = F.col("event_type")
    full = F.concat(F.lit('{"predicted_queue":"'), queue, F.lit('","generated_answer":"ok"}'))
    return read_table(spark, sf, "events").select(
        F.col("event_id").alias("ticket_id"),
        F.when(kind == 0, full)
        .when(kind == 1, F.concat(F.lit("Sure: "), full, F.lit(" done")))
        .when(kind == 2, F.concat(F.lit('{"predicted_queue":"'), queue, F.lit('"}')))
        .when(kind == 3, F.concat(F.lit('{"predicted_queue":'), queue, F.lit("}")))
        .when(kind == 4, F.lit("no object here"))
        .when(kind == 5, F.lit('{"predicted_queue":"a","generated_answer":"b"} and {more}'))
        .otherwise(F.lit('{"predicted_queue":null,"generated_answer":null}'))
        .alias("raw"),
    )
