"""Structured Streaming jobs: triage of a ticket stream, corpus appends, review rate over time."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ticketloom.operators import triage as T
from ticketloom.settings import DEFAULTS, JobSettings


def ticket_stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def first_sent(tickets: DataFrame, time_col: str, id_col: str = "ticket_id", resend_within: str = "7 days") -> DataFrame:
    """A stream in which a ticket that is sent again appears once, across batches and restarts.

    The state holds one id for each ticket until the watermark, the latest event time seen less
    ``resend_within``, passes it; a ticket sent again after that counts as new, and one whose event time is older than the
    watermark is dropped as too late.  Event times must be there.  Sent again with another text, a ticket
    keeps the one that came first; inside one batch either may be kept.  A ticket without an id is known by
    all its other values.
    """
    content = F.sha2(F.to_json(F.struct(*[F.col(c) for c in tickets.columns if c != time_col]), {"ignoreNullFields": "false"}), 256)
    key = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("-"), content))
    return tickets.withWatermark(time_col, resend_within).withColumn("_sent", key).dropDuplicatesWithinWatermark(["_sent"]).drop("_sent")


def triage_stream(
    tickets: DataFrame,
    corpus: Callable[[SparkSession], DataFrame],
    queues: Sequence[str],
    out: str,
    checkpoint: str,
    settings: JobSettings = DEFAULTS,
    generator: T.Generator = T.nearest_answer,
) -> StreamingQuery:
    """Triage every micro-batch against the corpus as it stands at that moment.

    A batch owns the folder of its id, so a batch that runs twice leaves one copy.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        # The batch is read several times (sizes, search, payload): keep it rather than refetch it.
        batch.persist()
        try:
            records = T.triage(batch, corpus(batch.sparkSession), queues, settings, generator)
            records.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return (
        tickets.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def corpus_base(corpus: DataFrame, corpus_path: str) -> None:
    """Lay down the corpus folder that :func:`append_stream` adds to."""
    corpus.write.mode("overwrite").parquet(f"{corpus_path}/batch_id=-1")


def append_stream(tickets: DataFrame, corpus_path: str, checkpoint: str) -> StreamingQuery:
    """Solved tickets join the corpus folder; the next search sees them, nothing is retrained."""
    return _per_batch(tickets.writeStream.outputMode("append"), corpus_path, checkpoint)


def _per_batch(writer, out: str, checkpoint: str) -> StreamingQuery:
    """Each batch owns the folder of its id, so one that runs twice leaves one copy."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return writer.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def review_rate(
    records: DataFrame, time_col: str, review_col: str, window: str = "1 day", lateness: str = "2 hours"
) -> DataFrame:
    """window_start, tickets, reviews per tumbling event-time window; works on a stream or a table.

    The watermark lets the state of closed windows go.
    """
    return (
        records.withWatermark(time_col, lateness)
        .groupBy(F.window(time_col, window).alias("w"))
        .agg(F.count(F.lit(1)).alias("tickets"), F.count_if(F.col(review_col)).alias("reviews"))
        .select(F.col("w.start").alias("window_start"), "tickets", "reviews")
    )


def update_stream(result: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Write what changed in each batch."""
    return _per_batch(result.writeStream.outputMode("update"), out, checkpoint)


def latest_updates(updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The newest version of each key from the folders :func:`update_stream` wrote."""
    values = [c for c in updates.columns if c not in (*keys, "batch_id")]
    return (
        updates.groupBy(*keys)
        .agg(F.max_by(F.struct(*values), "batch_id").alias("v"))
        .select(*keys, *[F.col(f"v.{c}").alias(c) for c in values])
    )
