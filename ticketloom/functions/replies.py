"""Prompt text and reply parsing, as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ticketloom.schemas import REPLY

# The wording of the prompt.
PROMPT_OPENING = (
    "You are a customer support routing assistant.\n\n"
    "Given a new support ticket and {count} similar resolved tickets as context,\n"
    "return a JSON object with exactly two keys:\n"
    '- "predicted_queue": one of the following queues:\n'
)
PROMPT_ANSWER_RULE = (
    '- "generated_answer": a helpful, concise response to the customer. Do not reproduce placeholder tokens '
    "(e.g. <tel_num>, <order_num>) found in the retrieved tickets; instead, write a natural sentence.\n\n"
    "Similar resolved tickets:\n---\n"
)
PROMPT_CLOSING = "Respond ONLY with valid JSON. No explanation, no markdown, no extra text."
QUEUE_BULLET = "  - "
BLOCK_SEPARATOR = "\n---\n"

REPLY_KEYS = ["predicted_queue", "generated_answer"]


def or_not_available(text: Column) -> Column:
    return F.when(text.isNull() | (text == ""), F.lit("N/A")).otherwise(text)


def prompt_text(subject: Column, body: Column, context: Column, queues: Sequence[str]) -> Column:
    """The prompt for one ticket; ``context`` is an array of (queue, body, answer) structs in order."""
    part = lambda x: F.coalesce(x, F.lit(""))
    blocks = F.transform(
        context,
        lambda x, i: F.concat(
            F.lit("[Ticket "), (i + 1).cast("string"), F.lit("]\nQueue: "), part(x["queue"]),
            F.lit("\nBody: "), part(x["body"]), F.lit("\nAnswer: "), part(x["answer"]),
        ),
    )
    before, after = PROMPT_OPENING.split("{count}")
    listed = "\n".join(QUEUE_BULLET + q for q in queues)
    return F.concat(
        F.lit(before), F.size(context).cast("string"), F.lit(after + listed + "\n" + PROMPT_ANSWER_RULE),
        F.array_join(blocks, BLOCK_SEPARATOR),
        F.lit("\n---\n\nNew ticket:\nSubject: "), or_not_available(subject),
        F.lit("\nBody: "), body, F.lit("\n\n" + PROMPT_CLOSING),
    )


def json_span(raw: Column) -> Column:
    """From the first opening to the last closing brace, line breaks included; '' if there is none."""
    return F.regexp_extract(raw, r"(?s)(\{.*\})", 1)


def parse_status(raw: Column) -> Column:
    """ok, no_object, invalid_json or missing_key; null for a null reply.

    Wrapping the span in brackets makes text after the object count: the array must have exactly
    one element.
    """
    span = json_span(raw)
    keys = F.json_object_keys(span)
    return (
        F.when(raw.isNull(), F.lit(None))
        .when(span == "", "no_object")
        .when(F.coalesce(F.json_array_length(F.concat(F.lit("["), span, F.lit("]"))), F.lit(0)) != 1, "invalid_json")
        .when(F.size(F.array_intersect(keys, F.array(*[F.lit(k) for k in REPLY_KEYS]))) < len(REPLY_KEYS), "missing_key")
        .otherwise("ok")
    )


def parsed_reply(raw: Column) -> Column:
    return F.from_json(json_span(raw), REPLY)
