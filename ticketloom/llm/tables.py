"""What the operators share: input columns, scratch tables, crc of an id."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.scale import materialize, scratch_path, shared_dir, short_batches  # noqa: F401
from ticketloom.sources.tables import read_table


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Rows of whole texts reach Python a thousand at a time, not ten thousand, unless the session sets a number itself.

    A batch is held by the JVM and by Python at once, and both count for the executor.
    """
    if spark.conf.get(BATCH_ROWS) == "10000":
        spark.conf.set(BATCH_ROWS, str(rows))


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone, so that no other column can clash; a null text is empty."""
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def fold(doc_id: str | Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    return (F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % parts).cast("int")


def without_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose ``doc_id`` is not in ``ids``, all columns kept; a null id counts as an id."""
    name = f"id_{uuid.uuid4().hex}"
    gone = materialize(ids.select(F.col("doc_id").alias(name)).distinct(), "gone")
    return docs.join(gone, docs["doc_id"].cast("long").eqNullSafe(gone[name]), "left_anti")
