"""Retrieval-grounded triage: abstain, prompt, generate, parse, and score the outcome."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketloom.functions import replies as J
from ticketloom.functions import text as X
from ticketloom.operators import features, metrics, overlap, retrieval
from ticketloom.scale import materialize
from ticketloom.settings import DEFAULTS, JobSettings

# A generator turns the gated table, whose ``prompt`` is null where the ticket abstains, into the
# raw reply column.
Generator = Callable[[DataFrame], Column]
# Tickets whose neighbour lists are small enough to broadcast.
FEW_TICKETS = 50_000
PAYLOAD = ("subject", "body", "answer", "queue")


def nearest_answer(df: DataFrame) -> Column:
    """Default generator: the queue and answer of the best context ticket, as a model would reply."""
    top = F.element_at("context", 1)
    reply = F.struct(
        F.coalesce(top["queue"], F.lit("")).alias("predicted_queue"),
        F.coalesce(top["answer"], F.lit("")).alias("generated_answer"),
    )
    return F.when(F.col("prompt").isNotNull(), F.to_json(reply))


def model_generator(load: Callable[[], Callable[[list[str]], list[str]]]) -> Generator:
    """Generator from a model: ``load`` runs once per task, and the model only ever sees the prompts
    of tickets that passed the gate."""

    def ask(batches):
        model = None
        for prompts in batches:
            out = pd.Series([None] * len(prompts), index=prompts.index, dtype=object)
            live = prompts.notna()
            if live.any():
                model = model or load()
                out[live] = model(prompts[live].tolist())
            yield out

    ask.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    # A model is paid by the call and may answer differently: no filter may pass below it and no
    # branch may repeat it.
    reply = F.pandas_udf(ask, T.StringType()).asNondeterministic()
    return lambda df: reply(F.col("prompt"))


def retrieve(tickets: DataFrame, corpus: DataFrame, k: int = DEFAULTS.top_k, id_col: str = "ticket_id") -> DataFrame:
    """Tickets with ``retrieved``: an empty array where the corpus offers nothing."""
    found = retrieval.nearest(tickets, corpus, k, id_col, corpus_extra=())
    if tickets.select(id_col).limit(FEW_TICKETS + 1).count() <= FEW_TICKETS:
        # At most FEW_TICKETS x k narrow rows: they go to the corpus, which is then read in place.
        found = retrieval.attach_payload(F.broadcast(found), corpus, PAYLOAD, id_col)
    else:
        # More of them meet the corpus in a shuffle, and a ticket that is many tickets' neighbour in several tasks.
        found = materialize(found, "neighbours")
        found = retrieval.attach_payload(found, corpus, PAYLOAD, id_col, retrieval.hot_neighbors(found))
    listed = retrieval.retrieved_list(found).withColumnRenamed("query_id", id_col)
    empty = F.array().cast(listed.schema["retrieved"].dataType)
    return tickets.join(listed, id_col, "left").withColumn("retrieved", F.coalesce("retrieved", empty))


def gate(df: DataFrame, threshold: float = DEFAULTS.confidence_threshold) -> DataFrame:
    """Adds confidence_score, nearest_queue and needs_human_review: best score strictly below the
    threshold, or nothing retrieved."""
    top = F.try_element_at("retrieved", F.lit(1))
    score = F.coalesce(top["score"], F.lit(0.0))
    return df.withColumns(
        {
            "confidence_score": score,
            "nearest_queue": F.coalesce(top["queue"], F.lit("Unknown")),
            "needs_human_review": score < threshold,
        }
    )


def overlap_score(query: Column, body: Column) -> Column:
    """Default second scorer: Jaccard similarity of the word sets."""
    return retrieval.token_overlap(X.whitespace_tokens(query), X.whitespace_tokens(body))


def rerank_context(
    df: DataFrame, keep: int = DEFAULTS.rerank_keep, query_col: str = "clean_body", scorer: Callable[[Column, Column], Column] = overlap_score
) -> DataFrame:
    """``context``: retrieved tickets by a second score, best first, first-pass order on ties.

    At most k items per row are sorted, inside the row.  ``retrieved`` keeps its order.
    """
    scored = F.transform(
        "retrieved",
        lambda x: F.struct(
            (-scorer(F.col(query_col), F.coalesce(x["body"], F.lit("")))).alias("minus_score"), x["rank"].alias("rank"), x.alias("ticket")
        ),
    )
    return df.withColumn("context", F.slice(F.transform(F.array_sort(scored), lambda s: s["ticket"]), 1, keep))


def add_prompt(df: DataFrame, queues: Sequence[str], subject_col: str = "subject", body_col: str = "body") -> DataFrame:
    """``prompt`` for tickets that passed the gate, from the body as written; null for the others."""
    if "context" not in df.columns:
        df = df.withColumn("context", F.col("retrieved"))
    text = J.prompt_text(F.col(subject_col), F.col(body_col), F.col("context"), queues)
    return df.withColumn("prompt", F.when(~F.col("needs_human_review"), text))


def generate(df: DataFrame, generator: Generator = nearest_answer) -> DataFrame:
    return df.withColumn("raw_reply", generator(df))


def parse_replies(df: DataFrame, raw_col: str = "raw_reply", queues: Sequence[str] | None = None, keep_raw: bool = False) -> DataFrame:
    """parse_status, reply_queue, reply_answer and, given the label list, queue_is_valid.  The raw
    text is dropped unless asked for."""
    out = df.withColumns({"parse_status": J.parse_status(F.col(raw_col)), "_reply": J.parsed_reply(F.col(raw_col))})
    fine = F.col("parse_status") == "ok"
    out = out.withColumns(
        {
            "reply_queue": F.when(fine, F.col("_reply.predicted_queue")),
            "reply_answer": F.when(fine, F.col("_reply.generated_answer")),
        }
    ).drop("_reply")
    if queues is not None:
        out = out.withColumn("queue_is_valid", F.col("reply_queue").isin(list(queues)))
    return out if keep_raw else out.drop(raw_col)


def triage(
    tickets: DataFrame,
    corpus: DataFrame,
    queues: Sequence[str],
    settings: JobSettings = DEFAULTS,
    generator: Generator = nearest_answer,
    rerank: bool = False,
    id_col: str = "ticket_id",
) -> DataFrame:
    """One record per ticket.

    Abstained tickets carry the nearest queue and no answer; a reply that cannot be parsed leaves
    queue and answer null with its ``parse_status``.
    """
    df = gate(retrieve(tickets, corpus, settings.top_k, id_col), settings.confidence_threshold)
    if rerank:
        df = rerank_context(df, settings.rerank_keep)
    df = parse_replies(generate(add_prompt(df, queues), generator), queues=queues)
    waits = F.col("needs_human_review")
    return df.select(
        *[c for c in tickets.columns if c != "embedding"],
        F.when(waits, F.col("nearest_queue")).otherwise(F.col("reply_queue")).alias("predicted_queue"),
        F.when(~waits, F.col("reply_answer")).alias("generated_answer"),
        "needs_human_review",
        "confidence_score",
        F.when(waits, F.lit("abstained")).otherwise(F.col("parse_status")).alias("parse_status"),
        F.when(~waits, F.col("queue_is_valid")).alias("queue_is_valid"),
        "retrieved",
    )


def public_response(records: DataFrame, id_col: str = "ticket_id") -> DataFrame:
    return records.select(id_col, "predicted_queue", "generated_answer", "needs_human_review", "confidence_score")


def encode_tickets(df: DataFrame, encoder: features.Encoder | None = None, dim: int = DEFAULTS.embedding_dim, id_col: str = "ticket_id") -> DataFrame:
    """clean_body and its embedding; the raw body stays for the prompt."""
    clean = df.select("*", F.inline(F.array(F.struct(X.clean_text(F.col("body")).alias("clean_body")))))
    return features.embed(clean, "clean_body", encoder, id_col, dim)


def evaluation_summary(
    records: DataFrame, truth: str = "queue", reference: str = "answer", id_col: str = "ticket_id", stemmed: bool = True, digits: int = 4
) -> DataFrame:
    """metric, value.

    Records whose reply failed to parse, or named no queue, are left out.  An abstained ticket with
    a queue guess is scored on the guess.  ``sample_size`` and ``abstention_rate_ref`` count such a
    ticket twice, as the published figures do; ``tickets`` and ``abstention_rate`` count it once.
    What is scored is written once, so a generator behind it runs once for each ticket.
    """
    needed = dict.fromkeys([id_col, truth, reference, "predicted_queue", "generated_answer", "needs_human_review", "parse_status"])
    records = materialize(records.select(*needed), "scored-records")
    named = F.col("predicted_queue").isNotNull() & (F.col("predicted_queue") != "")
    waits = F.col("needs_human_review")
    used = records.where(waits | ((F.col("parse_status") == "ok") & named))
    guess = waits & named & (F.col("predicted_queue") != "Unknown")
    counts = used.agg(
        F.count(F.lit(1)).alias("tickets"),
        F.count_if(waits).alias("abstained"),
        F.count_if(~waits | guess).alias("scored_queues"),
    ).withColumn("sample_size", F.col("scored_queues") + F.col("abstained"))
    rate = lambda over: F.when(F.col(over) > 0, F.round(F.col("abstained") / F.col(over), digits)).otherwise(F.lit(0.0))
    counts = counts.withColumns({"abstention_rate_ref": rate("sample_size"), "abstention_rate": rate("tickets")})
    names = ["sample_size", "tickets", "abstained", "scored_queues", "abstention_rate_ref", "abstention_rate"]
    queue_scores = metrics.weighted_scores(used.where(~waits | guess), truth, "predicted_queue", digits).select(
        F.col("accuracy").alias("queue_accuracy"), F.col("f1").alias("queue_weighted_f1")
    )
    answered = used.where(~waits).select(id_col, reference, "generated_answer")
    answer_scores = overlap.mean_overlap(overlap.text_overlap(answered, reference, "generated_answer", id_col, stemmed), digits)
    long = lambda df, cols: df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], cols, "metric", "value")
    return (
        long(counts, names)
        .unionByName(long(queue_scores, ["queue_accuracy", "queue_weighted_f1"]))
        .unionByName(long(answer_scores.withColumnRenamed("scored", "scored_answers"), ["scored_answers", "mean_bleu", "mean_rouge_l"]))
    )


def against_baseline(
    records: DataFrame, predictions: DataFrame, baseline_col: str, truth: str = "queue", id_col: str = "ticket_id", digits: int = 4
) -> DataFrame:
    """metric, base, other, delta, delta_pct, tickets: a trained family's queues (``base``) against the triage's (``other``).

    Both are scored on the same tickets, those that have a record and a prediction; an abstained
    ticket counts with its nearest queue.  A missing prediction is a wrong one; without such tickets there are no rows.
    """
    both = records.select(id_col, truth, F.coalesce("predicted_queue", F.lit("Unknown")).alias("other")).join(
        predictions.select(id_col, F.coalesce(baseline_col, F.lit("Unknown")).alias("base")), id_col
    ).where(F.col(truth).isNotNull())
    long = both.unpivot([truth], ["base", "other"], "side", "predicted_queue")
    sizes = long.groupBy("side").agg(F.count(F.lit(1)).alias("tickets"))
    # Two rows, then eight: the sides' scores.
    scores = metrics.weighted_scores(long, truth, "predicted_queue", digits, by=["side"]).join(sizes, "side")
    rows = scores.unpivot(["side", "tickets"], ["accuracy", "precision", "recall", "f1"], "metric", "value")
    other = rows.where("side = 'other'")
    return metrics.metric_delta(rows.where("side = 'base'"), other, digits).join(other.select("metric", "tickets"), "metric")
