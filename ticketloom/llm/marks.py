"""A bitmap of fixed size that tells which keys a table may hold, so that the rest need not be shuffled."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.arrays import ArrowJob

MARK_BITS = 1 << 26
PART_BYTES = 4096  # of one of Spark's bitmaps


def marks(keys: DataFrame, column: str, bits: int = MARK_BITS) -> np.ndarray:
    """One bit for each residue, modulo ``bits``, that a key of ``column`` has: ``bits / 8`` bytes, however many keys."""
    at = F.pmod(F.col(column), F.lit(bits)) + 1  # Spark counts the places of a bitmap, and its buckets, from 1
    parts = keys.select(at.alias("at")).groupBy(F.expr("bitmap_bucket_number(at)").alias("bucket")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(at))").alias("held")).toArrow()
    out = np.zeros(bits // 8, np.uint8)
    for bucket, held in zip(parts.column("bucket").to_pylist(), parts.column("held").to_pylist(), strict=True):
        out[(bucket - 1) * PART_BYTES : bucket * PART_BYTES] = np.frombuffer(held, np.uint8)
    return out


def marked_job(column: str, held: np.ndarray, wanted: bool = True, bits: int = MARK_BITS) -> ArrowJob:
    """The rows whose key is marked, or those whose key is not."""

    def job(batches):
        for batch in batches:
            at = batch.column(column).to_numpy() % bits
            hit = (held[at // 8] >> (at % 8)) & 1 == 1
            yield batch.filter(pa.array(hit == wanted))

    return job
