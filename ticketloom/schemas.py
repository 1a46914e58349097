"""Record layouts, as StructTypes."""

from __future__ import annotations

from pyspark.sql import types as T

TAG_COLUMNS = [f"tag_{i}" for i in range(1, 9)]

RAW_TICKET = T.StructType(
    [T.StructField("ticket_id", T.LongType(), False)]
    + [
        T.StructField(name, T.StringType(), True)
        for name in ["subject", "body", "answer", "type", "queue", "priority", "language"] + TAG_COLUMNS
    ]
)

TICKET = T.StructType(
    [
        T.StructField("ticket_id", T.LongType(), False),
        T.StructField("subject", T.StringType(), True),
        T.StructField("body", T.StringType(), False),
    ]
)

RETRIEVED_TICKET = T.StructType(
    [
        T.StructField("rank", T.IntegerType(), True),
        T.StructField("subject", T.StringType(), True),
        T.StructField("body", T.StringType(), True),
        T.StructField("answer", T.StringType(), True),
        T.StructField("queue", T.StringType(), True),
        T.StructField("score", T.DoubleType(), True),
    ]
)

TRIAGE_RECORD = T.StructType(
    [
        T.StructField("ticket_id", T.LongType(), True),
        T.StructField("predicted_queue", T.StringType(), True),
        T.StructField("generated_answer", T.StringType(), True),
        T.StructField("needs_human_review", T.BooleanType(), True),
        T.StructField("confidence_score", T.DoubleType(), True),
        T.StructField("retrieved", T.ArrayType(RETRIEVED_TICKET), True),
    ]
)

REPLY = T.StructType(
    [
        T.StructField("predicted_queue", T.StringType(), True),
        T.StructField("generated_answer", T.StringType(), True),
    ]
)
