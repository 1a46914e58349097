"""Streams drained to the end and read back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketloom.operators import metrics as M
from ticketloom.plans import fragments as Q
from ticketloom.plans.registry import query
from ticketloom.plans.triage_queries import RECORDS_SQL, CASE_SETTINGS, split_cases
from ticketloom.scale import materialize, scratch_path
from ticketloom.sources import tables as IO
from ticketloom.sources import views
from ticketloom.streaming import jobs


def _drain(stream_query) -> None:
    stream_query.awaitTermination()


@query(
    "stream_triage",
    f"""WITH {RECORDS_SQL} SELECT ticket_id, predicted_queue, generated_answer, needs_human_review, round(confidence_score, 6) AS confidence_score FROM rec""",
)
def stream_triage(spark, sf):
    asked, corpus = split_cases(spark, sf)
    home = scratch_path(spark, "stream-triage")
    asked.write.parquet(f"{home}/in")
    corpus.write.parquet(f"{home}/corpus")
    stream = jobs.ticket_stream(spark, f"{home}/in", asked.schema)
    queues = M.label_list(views.cases(spark, sf))
    _drain(jobs.triage_stream(stream, lambda s: s.read.parquet(f"{home}/corpus"), queues, f"{home}/out", f"{home}/state", CASE_SETTINGS))
    return spark.read.parquet(f"{home}/out").select(
        "ticket_id", "predicted_queue", "generated_answer", "needs_human_review",
        F.round("confidence_score", 6).alias("confidence_score"),
    )


@query(
    "stream_append",
    f"WITH {Q.CASES}, {Q.split('v_cases')} SELECT ticket_id, queue, split FROM parts WHERE split IN ('train', 'val')",
)
def stream_append(spark, sf):
    """A corpus of train cases to which the validation cases arrive as a stream."""
    from ticketloom.operators.split import stratified_split

    parts = materialize(stratified_split(views.cases(spark, sf)).select("ticket_id", "queue", "split"), "append-parts")
    home = scratch_path(spark, "stream-append")
    jobs.corpus_base(parts.where("split = 'train'"), f"{home}/corpus")
    parts.where("split = 'val'").write.parquet(f"{home}/in")
    _drain(jobs.append_stream(jobs.ticket_stream(spark, f"{home}/in", parts.schema), f"{home}/corpus", f"{home}/state"))
    return spark.read.parquet(f"{home}/corpus").select("ticket_id", "queue", "split")


@query(
    "stream_resent",
    f"WITH {Q.CASES}, {Q.split('v_cases')} SELECT ticket_id, queue, body FROM parts WHERE split IN ('train', 'val')",
)
def stream_resent(spark, sf):
    """As ``stream_append``, but every ticket is sent three times, and the job stops and starts between."""
    from ticketloom.operators.split import stratified_split

    parts = materialize(stratified_split(views.cases(spark, sf)).select("ticket_id", "queue", "body", "split"), "resent-parts")
    home = scratch_path(spark, "stream-resent")
    jobs.corpus_base(parts.where("split = 'train'").drop("split"), f"{home}/corpus")
    came = parts.where("split = 'val'").drop("split").withColumn("sent", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("ticket_id") % 3600))
    later = lambda hours: came.withColumn("sent", F.col("sent") + F.make_interval(hours=F.lit(hours)))
    for batch in (came, later(1).unionByName(later(2))):
        batch.write.mode("append").parquet(f"{home}/in")
        fresh = jobs.first_sent(jobs.ticket_stream(spark, f"{home}/in", came.schema), "sent", resend_within="1 day")
        _drain(jobs.append_stream(fresh.drop("sent"), f"{home}/corpus", f"{home}/state"))
    return spark.read.parquet(f"{home}/corpus").select("ticket_id", "queue", "body")


@query(
    "stream_review_rate",
    """SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS window_day, count(*) AS tickets, count(*) FILTER (value < 20) AS reviews, round(count(*) FILTER (value < 20) / count(*), 4) AS review_rate
FROM events GROUP BY 1""",
)
def stream_review_rate(spark, sf):
    home = scratch_path(spark, "stream-review")
    stored = IO.read_table(spark, sf, "events")
    # The events carry wall-clock times; windows are laid out in the same clock.
    events = spark.readStream.schema(stored.schema).parquet(f"{sf}/events*.parquet").select(
        F.col("ts").cast(T.TimestampType()).alias("ts"), (F.col("value") < 20).alias("needs_human_review")
    )
    rate = jobs.review_rate(events, "ts", "needs_human_review")
    _drain(jobs.update_stream(rate, f"{home}/out", f"{home}/state"))
    return jobs.latest_updates(spark.read.parquet(f"{home}/out"), ["window_start"]).select(
        F.date_format("window_start", "yyyy-MM-dd").alias("window_day"), "tickets", "reviews",
        F.round(F.col("reviews") / F.col("tickets"), 4).alias("review_rate"),
    )
