from pyspark.sql import functions as F

from ticketloom.scale import scratch_path
from ticketloom.streaming import jobs

CORPUS = "ticket_id long, subject string, body string, answer string, queue string, embedding array<float>"
TICKET = "ticket_id long, subject string, body string, clean_body string, embedding array<float>"


def test_batches_triage_against_a_growing_corpus(spark):
    home = scratch_path(spark, "t-stream")
    base = spark.createDataFrame([(1, None, "old", "first answer", "A", [1.0, 0.0])], CORPUS)
    jobs.corpus_base(base, f"{home}/corpus")
    ask = lambda i: spark.createDataFrame([(i, None, "q", "q", [0.0, 1.0])], TICKET).write.mode("append").parquet(f"{home}/in")
    schema = spark.createDataFrame([], TICKET).schema
    run = lambda: jobs.triage_stream(
        jobs.ticket_stream(spark, f"{home}/in", schema, 1), lambda s: s.read.parquet(f"{home}/corpus"), ["A", "B"], f"{home}/out", f"{home}/state"
    ).awaitTermination()
    ask(100)
    run()
    spark.createDataFrame([(2, None, "new", "second answer", "B", [0.0, 1.0])], CORPUS).write.parquet(f"{home}/solved")
    jobs.append_stream(
        jobs.ticket_stream(spark, f"{home}/solved", base.schema), f"{home}/corpus", f"{home}/append-state"
    ).awaitTermination()
    ask(101)
    run()
    got = {r["ticket_id"]: r for r in spark.read.parquet(f"{home}/out").collect()}
    assert got[100]["needs_human_review"] and got[100]["generated_answer"] is None
    assert got[101]["generated_answer"] == "second answer" and got[101]["predicted_queue"] == "B"
    assert len(got) == 2


def test_review_rate_updates_late_windows(spark):
    home = scratch_path(spark, "t-rate")
    put = lambda rows: spark.createDataFrame(rows, "ts string, needs_human_review boolean").select(
        F.to_timestamp("ts").alias("ts"), "needs_human_review"
    ).write.mode("append").parquet(f"{home}/in")
    def run():
        stream = spark.readStream.schema("ts timestamp, needs_human_review boolean").parquet(f"{home}/in")
        jobs.update_stream(jobs.review_rate(stream, "ts", "needs_human_review", "1 hour"), f"{home}/out", f"{home}/state").awaitTermination()
    put([("2024-01-01 00:10:00", True), ("2024-01-01 00:20:00", False)])
    run()
    put([("2024-01-01 00:40:00", True), ("2024-01-01 01:10:00", False)])
    run()
    rows = jobs.latest_updates(spark.read.parquet(f"{home}/out"), ["window_start"]).orderBy("window_start").collect()
    assert [(r["tickets"], r["reviews"]) for r in rows] == [(3, 2), (1, 0)]


RESENT = "ticket_id long, subject string, body string, clean_body string, embedding array<float>, sent timestamp"


def test_a_resent_ticket_is_answered_once(spark):
    home = scratch_path(spark, "t-resent")
    spark.createDataFrame([(1, None, "old", "first answer", "A", [1.0, 0.0])], CORPUS).write.parquet(f"{home}/corpus")
    schema = spark.createDataFrame([], RESENT).schema
    starts = []

    def send(*tickets):
        rows = spark.createDataFrame([(i, None, body, body, [1.0, 0.0], at) for i, body, at in tickets], RESENT.replace("timestamp", "string"))
        rows.withColumn("sent", F.to_timestamp("sent")).write.mode("append").parquet(f"{home}/in")
        # Every call is a new start from the checkpoint.
        fresh = jobs.first_sent(jobs.ticket_stream(spark, f"{home}/in", schema, 1), "sent", resend_within="1 hour")
        jobs.triage_stream(fresh, lambda s: s.read.parquet(f"{home}/corpus"), ["A"], f"{home}/out", f"{home}/state").awaitTermination()
        starts.append(sorted((r["ticket_id"] or 0, r["body"]) for r in spark.read.parquet(f"{home}/out").collect()))

    send((7, "a", "2024-01-01 10:00:00"), (7, "a", "2024-01-01 10:01:00"), (None, "x", "2024-01-01 10:00:00"), (None, "y", "2024-01-01 10:00:00"))
    assert starts[-1] == [(0, "x"), (0, "y"), (7, "a")]
    send((7, "a", "2024-01-01 10:30:00"), (7, "changed", "2024-01-01 10:31:00"), (None, "x", "2024-01-01 10:31:00"), (8, "b", "2024-01-01 10:20:00"))
    assert starts[-1] == [(0, "x"), (0, "y"), (7, "a"), (8, "b")]
    # Past the watermark the id is forgotten.
    send((9, "c", "2024-01-01 14:00:00"))
    send((10, "d", "2024-01-01 14:01:00"))
    send((7, "a", "2024-01-01 14:02:00"))
    assert starts[-1] == [(0, "x"), (0, "y"), (7, "a"), (7, "a"), (8, "b"), (9, "c"), (10, "d")]
