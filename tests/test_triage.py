import json

import pytest
from pyspark.sql import functions as F

from ticketloom.functions import replies as J
from ticketloom.operators import features as E
from ticketloom.operators import triage as T
from ticketloom.settings import JobSettings

QUEUES = ["Billing", "IT Support"]


def corpus(spark):
    rows = [
        (10, None, "invoice is wrong", "We fixed the invoice.", "Billing", [1.0, 0.0, 0.0]),
        (11, "vpn", "vpn does not connect", "Restart the client.", "IT Support", [0.0, 1.0, 0.0]),
        (12, "", "invoice twice", "Refunded.", "Billing", [0.8, 0.6, 0.0]),
    ]
    return spark.createDataFrame(
        rows, "ticket_id long, subject string, body string, answer string, queue string, embedding array<float>"
    )


def asked(spark, *vectors):
    rows = [(i + 1, None if i % 2 else "", f"ticket {i}", f"ticket {i}", [float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "ticket_id long, subject string, body string, clean_body string, embedding array<float>")


@pytest.mark.parametrize("score,waits", [(None, True), (0.10, True), (0.5499, True), (0.55, False), (0.9, False)])
def test_gate(spark, score, waits):
    items = [] if score is None else [(1, "q", score)]
    df = spark.createDataFrame([(1, items)], "ticket_id long, retrieved array<struct<rank:int,queue:string,score:double>>")
    row = T.gate(df, 0.55).first()
    assert row["needs_human_review"] is waits
    assert row["nearest_queue"] == ("Unknown" if score is None else "q")
    assert row["confidence_score"] == (score or 0.0)


def test_records(spark):
    got = {r["ticket_id"]: r for r in T.triage(asked(spark, (1.2, 0, 0), (0, 0, 1.0)), corpus(spark), QUEUES).collect()}
    sure, unsure = got[1], got[2]
    assert (sure["predicted_queue"], sure["generated_answer"], sure["needs_human_review"]) == ("Billing", "We fixed the invoice.", False)
    assert sure["confidence_score"] == 1.0 and sure["queue_is_valid"] and sure["parse_status"] == "ok"
    assert [x["queue"] for x in sure["retrieved"]] == ["Billing", "Billing", "IT Support"]
    assert unsure["generated_answer"] is None and unsure["needs_human_review"] and unsure["parse_status"] == "abstained"
    assert T.public_response(T.triage(asked(spark, (1, 0, 0)), corpus(spark), QUEUES)).columns == [
        "ticket_id", "predicted_queue", "generated_answer", "needs_human_review", "confidence_score",
    ]


def test_no_corpus(spark):
    row = T.triage(asked(spark, (1, 0, 0)), corpus(spark).where("false"), QUEUES).first()
    assert (row["predicted_queue"], row["confidence_score"], row["needs_human_review"]) == ("Unknown", 0.0, True)
    assert row["retrieved"] == []


def test_model_sees_only_tickets_that_pass(spark):
    calls = spark.sparkContext.accumulator(0)

    def load():
        def reply(prompts):
            calls.add(len(prompts))
            return [json.dumps({"predicted_queue": "IT Support", "generated_answer": "done"})] * len(prompts)

        return reply

    out = T.triage(asked(spark, (0, 0, 1.0), (0, 0, 1.0)), corpus(spark), QUEUES, generator=T.model_generator(load))
    assert out.where("needs_human_review").count() == 2
    out.collect()
    assert calls.value == 0
    out = T.triage(asked(spark, (1, 0, 0), (0, 0, 1.0)), corpus(spark), QUEUES, generator=T.model_generator(load))
    assert {r["ticket_id"]: r["predicted_queue"] for r in out.collect()}[1] == "IT Support"
    assert calls.value == 1


def test_bad_reply_is_a_status_and_stays_private(spark):
    generator = T.model_generator(lambda: lambda prompts: ["secret nonsense"] * len(prompts))
    row = T.triage(asked(spark, (1, 0, 0)), corpus(spark), QUEUES, generator=generator).first()
    assert (row["parse_status"], row["predicted_queue"], row["generated_answer"]) == ("no_object", None, None)
    assert "secret" not in str(row)


REPLIES = [
    (None, None), ("no object", "no_object"), ('{"predicted_queue":"a","generated_answer":"b"}', "ok"),
    ('text {"predicted_queue":"a",\n"generated_answer":"b"} text', "ok"), ('{"predicted_queue":"a"}', "missing_key"),
    ('{"predicted_queue":null,"generated_answer":null}', "ok"), ('{"a":1},{"b":2}', "invalid_json"),
    ('{"predicted_queue":"a","generated_answer":"b"} and {more}', "invalid_json"), ("{x}", "invalid_json"), ("{", "no_object"),
    ('{"predicted_queue":"a","generated_answer":"b","extra":[1,{"z":2}]}', "ok"),
]


@pytest.mark.parametrize("raw,want", REPLIES)
def test_parse_status(spark, raw, want):
    df = spark.createDataFrame([(raw,)], "raw string")
    assert df.select(J.parse_status(F.col("raw"))).first()[0] == want


def test_valid_queue_flag(spark):
    df = spark.createDataFrame([('{"predicted_queue":"Nope","generated_answer":"b"}',)], "raw_reply string")
    row = T.parse_replies(df, queues=QUEUES).first()
    assert row["queue_is_valid"] is False and row["reply_queue"] == "Nope" and "raw_reply" not in row.asDict()


def test_prompt(spark):
    df = T.add_prompt(T.gate(T.retrieve(asked(spark, (1, 0, 0)), corpus(spark), 2), 0.5), QUEUES)
    text = df.first()["prompt"]
    assert text.startswith("You are a customer support routing assistant.\n\nGiven a new support ticket and 2 similar")
    assert "  - Billing\n  - IT Support\n- \"generated_answer\"" in text
    assert "[Ticket 1]\nQueue: Billing\nBody: invoice is wrong\nAnswer: We fixed the invoice.\n---\n[Ticket 2]\n" in text
    assert "New ticket:\nSubject: N/A\nBody: ticket 0\n\nRespond ONLY" in text


def test_rerank_orders_context_only(spark):
    tickets = asked(spark, (1, 0, 0)).withColumn("clean_body", F.lit("vpn does not connect"))
    row = T.rerank_context(T.retrieve(tickets, corpus(spark), 3), keep=2).first()
    assert [x["queue"] for x in row["context"]] == ["IT Support", "Billing"]
    assert [x["rank"] for x in row["retrieved"]] == [1, 2, 3]


def test_summary_counts_abstained_both_ways(spark):
    rows = [
        (1, "a", "x y", "a", "x y", False, "ok"), (2, "a", "x", "b", None, True, "abstained"),
        (3, "b", "x", "Unknown", None, True, "abstained"), (4, "b", "x", None, None, False, "invalid_json"),
    ]
    df = spark.createDataFrame(
        rows, "ticket_id long, queue string, answer string, predicted_queue string, generated_answer string, needs_human_review boolean, parse_status string"
    )
    got = {r[0]: r[1] for r in T.evaluation_summary(df).collect()}
    assert (got["sample_size"], got["tickets"], got["abstained"], got["scored_queues"]) == (4.0, 3.0, 2.0, 2.0)
    assert (got["abstention_rate_ref"], got["abstention_rate"]) == (0.5, 0.6667)
    assert (got["queue_accuracy"], got["scored_answers"], got["mean_rouge_l"]) == (0.5, 1.0, 1.0)


def test_custom_encoder(spark):
    df = spark.createDataFrame([(1, "ab"), (2, "abcd"), (3, None)], "ticket_id long, clean_body string")

    def load():
        import numpy as np

        return lambda texts: np.array([[len(t), 1.0 if t else 0.0] for t in texts])

    got = {r[0]: r[1] for r in E.embed(df, encoder=E.model_encoder(load)).select("ticket_id", "embedding").collect()}
    assert abs(sum(x * x for x in got[2]) - 1) < 1e-6 and got[3] == [0.0, 0.0]


def test_hashed_vectors_have_unit_length(spark):
    df = spark.createDataFrame([(1, "reset my password"), (2, ""), (3, None), (4, "reset my password")], "ticket_id long, clean_body string")
    got = {r[0]: r[1] for r in E.hashed_vectors(df, "clean_body", 16).collect()}
    assert set(got) == {1, 2, 3, 4} and got[1] == got[4] and got[2] == [0.0] * 16
    assert abs(sum(x * x for x in got[1]) - 1) < 1e-6


def test_encode_then_triage_end_to_end(spark):
    text = "the invoice total is wrong please correct it"
    old = spark.createDataFrame([(1, None, text, "Corrected.", "Billing")], "ticket_id long, subject string, body string, answer string, queue string")
    new = spark.createDataFrame([(2, "Hi", text.upper() + "!!")], "ticket_id long, subject string, body string")
    row = T.triage(T.encode_tickets(new), T.encode_tickets(old), ["Billing"], JobSettings(top_k=3)).first()
    assert row["generated_answer"] == "Corrected." and row["confidence_score"] > 0.999


def test_model_is_asked_once_per_ticket(spark):
    calls = spark.sparkContext.accumulator(0)

    def load():
        def reply(prompts):
            calls.add(len(prompts))
            return [json.dumps({"predicted_queue": "IT Support", "generated_answer": "done"})] * len(prompts)

        return reply

    out = T.triage(asked(spark, (1, 0, 0), (0, 0, 1.0)), corpus(spark), QUEUES, generator=T.model_generator(load))
    assert out.where("parse_status = 'ok'").count() == 1
    assert calls.value == 1
    truth = out.withColumn("queue", F.lit("IT Support")).withColumn("answer", F.lit("done"))
    T.evaluation_summary(truth).collect()
    assert calls.value == 2


def test_triage_against_a_trained_family(spark):
    rows = [(1, "A", "A"), (2, "A", "B"), (3, "B", None), (4, "B", "B"), (5, None, "A"), (6, "A", "A")]
    records = spark.createDataFrame(rows, "ticket_id long, queue string, predicted_queue string")
    trained = spark.createDataFrame([(1, "A"), (2, "A"), (3, "B"), (4, None), (5, "A"), (9, "B")], "ticket_id long, pred string")
    got = {r["metric"]: r for r in T.against_baseline(records, trained, "pred").collect()}
    # Tickets 1 to 4 have a label, a record and a prediction: three of four right against two of four.
    assert (got["accuracy"]["base"], got["accuracy"]["other"], got["accuracy"]["delta"], got["accuracy"]["delta_pct"]) == (0.75, 0.5, -0.25, -33.3)
    # Trained: A is right twice, B once of two, never wrongly named; F1 (1 + 2/3) / 2.  Triage: A 2/3, B 1/2.
    assert (got["f1"]["base"], got["f1"]["other"]) == (0.8333, 0.5833)
    assert {r["tickets"] for r in got.values()} == {4} and len(got) == 4
    assert T.against_baseline(records.where("false"), trained, "pred").count() == 0


def test_facts_seen_while_vectors_are_written(spark):
    def facts(*vectors):
        df = spark.createDataFrame([(i, None if v is None else [float(x) for x in v]) for i, v in enumerate(vectors)], "ticket_id long, embedding array<float>")
        stored, seen = E.store_vectors(df, "facts")
        assert stored.count() == len(vectors)
        return seen

    good = facts((1, 0), (0, -1), (0, 0))
    assert (good.rows, good.missing, good.empty, good.widths) == (3, 0, 1, (2, 2))
    good.require_unit()
    good.require_complete()
    for bad in (((1, 0), (2, 0)), ((1, 0), (0, 1, 0)), ((1, 0), (float("nan"), 0)), ((0.5, 0.5),)):
        with pytest.raises(ValueError):
            facts(*bad).require_unit()
    with pytest.raises(ValueError):
        facts((1, 0), None).require_complete()
    facts().require_unit()


def test_an_encoder_that_leaves_a_ticket_out_does_not_lose_it(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "ticket_id long, body string")
    half = lambda d, t, i: d.where("ticket_id = 1").select(i, F.array(F.lit(1.0)).cast("array<float>").alias("embedding"))
    rows = {r["ticket_id"]: r["embedding"] for r in T.encode_tickets(df, half).collect()}
    assert rows == {1: [1.0], 2: None}
