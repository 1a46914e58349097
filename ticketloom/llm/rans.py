"""Token ids in files coded by a static range asymmetric numeral system.

One table of symbol frequencies, counted over all documents, serves every block.  A block holds
whole documents and stands alone: ``LANES`` coder states take turns over its ids and share one
stream of 16-bit words.  Every ``MARK_STEPS`` turns the states and the place in the stream are kept
as a checkpoint, so the parts of a block are decoded side by side; a checksum covers the block.

The files are a Parquet table of blocks (:data:`BLOCKS`) in ascending order of ``doc_id``: ``shard``
and ``block`` give the order, ``doc_ids`` and ``lengths`` the documents in it, ``payload`` the coded
ids.  Beside it lies the table of frequencies.

A null text counts as empty and has its end id alone.  Null ids come first; rows that share an id
lie in the order of their first ``HEAD`` characters, then of a digest.  An empty table gives no block.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ticketloom.llm.arrays import ArrowJob, binaries, encoder, slices, tidy
from ticketloom.llm.tables import materialize, scratch_path, texts

BITS = 16
TOTAL = 1 << BITS
LOW = 1 << 16
LANES = 1024
MARK_STEPS = 128
BLOCK_IDS = 1 << 19
MAGIC = b"TLR1"
HEADER = struct.Struct("<4sIIQQI")  # magic, lanes, steps between checkpoints, ids, words, checkpoints
HEAD = 16
ID_ROWS = "doc_id long, head string, digest long, wide int, ids binary"
BLOCKS = "shard int, block int, n_ids long, doc_ids array<long>, lengths array<long>, payload binary"


def frequencies(counts: np.ndarray) -> np.ndarray:
    """Frequencies that add up to ``TOTAL``, in proportion to the counts; each seen symbol has one at least."""
    counts = np.asarray(counts, np.float64)
    seen = counts > 0
    if not seen.any():
        return np.zeros(len(counts), np.uint64)
    if seen.sum() > TOTAL:
        raise ValueError(f"{int(seen.sum())} symbols do not fit a table of {TOTAL}")
    freq = np.where(seen, np.maximum(1, np.floor(counts * (TOTAL / counts.sum()))), 0).astype(np.int64)
    order = np.argsort(-freq, kind="stable")
    over = int(freq.sum()) - TOTAL
    while over > 0:
        room = freq - seen
        take = np.minimum(room, room * over // max(1, int(room.sum())))
        if not take.any():
            spare = order[room[order] > 0][:over]
            take[spare] = 1
        freq -= take
        over -= int(take.sum())
    freq[order[0]] -= over
    return freq.astype(np.uint64)


class Table:
    """Frequencies, where each symbol's range begins, and the symbol of each place."""

    def __init__(self, freq: np.ndarray):
        self.freq = np.asarray(freq, np.uint64)
        self.begin = np.cumsum(self.freq) - self.freq
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), self.freq.astype(np.int64))


def encode(ids: np.ndarray, table: Table) -> bytes:
    n = len(ids)
    lanes = min(LANES, max(1, n // 64))
    steps = -(-n // lanes)
    state = np.full(lanes, LOW, np.uint64)
    words, written, marks = [], 0, []
    freq, begin = table.freq[ids], table.begin[ids]
    if n and not freq.all():
        raise ValueError("an id is not in the table")
    sixteen = np.uint64(16)
    for t in range(steps - 1, -1, -1):
        f, c = freq[t * lanes : (t + 1) * lanes], begin[t * lanes : (t + 1) * lanes]
        x = state[: len(f)]
        over = x >= (f << sixteen)
        out = x[over]
        if len(out):
            words.append((out & np.uint64(0xFFFF)).astype("<u2"))
            written += len(out)
            x = np.where(over, x >> sixteen, x)
        whole = x // f
        state[: len(f)] = (whole << sixteen) + (x - whole * f) + c
        if t % MARK_STEPS == 0:
            marks.append((written, state.astype("<u4")))
    stream = np.concatenate(words[::-1]) if words else np.zeros(0, "<u2")
    marks.reverse()
    places = np.array([written - w for w, _ in marks], "<u8")
    states = np.concatenate([s for _, s in marks]) if marks else np.zeros(0, "<u4")
    body = HEADER.pack(MAGIC, lanes, MARK_STEPS, n, len(stream), len(marks)) + places.tobytes() + states.tobytes() + stream.tobytes()
    return body + struct.pack("<II", zlib.crc32(np.asarray(ids, "<u4").tobytes()), zlib.crc32(body))


def _decode_parts(stream, places, states, steps: int, lanes: int, last: int, table: Table) -> np.ndarray:
    """Parts of ``steps`` turns each, side by side; the last turn holds ``last`` ids."""
    x = states.astype(np.uint64)
    place = places.astype(np.int64)
    out = np.zeros((len(places), steps, lanes), np.uint32)
    mask, sixteen = np.uint64(TOTAL - 1), np.uint64(16)
    for t in range(steps):
        k = last if t == steps - 1 else lanes
        low = (x[:, :k] & mask).astype(np.int64)
        symbol = table.symbol[low]
        out[:, t, :k] = symbol
        now = table.freq[symbol] * (x[:, :k] >> sixteen) + low.astype(np.uint64) - table.begin[symbol]
        need = now < LOW
        at = (np.cumsum(need, axis=1) - 1 + place[:, None])[need]
        now[need] = (now[need] << sixteen) | stream[at].astype(np.uint64)
        place += need.sum(axis=1)
        x[:, :k] = now
    return out.reshape(len(places), -1)[:, : (steps - 1) * lanes + last]


def decode(payload: bytes, table: Table) -> np.ndarray:
    """The ids of a block; raises if a checksum is wrong."""
    body, (ids_crc, body_crc) = payload[:-8], struct.unpack("<II", payload[-8:])
    if zlib.crc32(body) != body_crc or body[:4] != MAGIC:
        raise ValueError("damaged block")
    _, lanes, mark_steps, n, n_words, n_marks = HEADER.unpack_from(body)
    at = HEADER.size
    places = np.frombuffer(body, "<u8", n_marks, at)
    states = np.frombuffer(body, "<u4", n_marks * lanes, at + 8 * n_marks).reshape(n_marks, lanes)
    stream = np.frombuffer(body, "<u2", n_words, at + 8 * n_marks + 4 * n_marks * lanes)
    parts = []
    if n_marks > 1:
        parts.append(_decode_parts(stream, places[:-1], states[:-1], mark_steps, lanes, lanes, table).ravel())
    if n_marks:
        rest = n - (n_marks - 1) * mark_steps * lanes
        steps = -(-rest // lanes)
        parts.append(_decode_parts(stream, places[-1:], states[-1:], steps, lanes, rest - (steps - 1) * lanes, table).ravel())
    ids = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
    if zlib.crc32(ids.astype("<u4").tobytes()) != ids_crc:
        raise ValueError("the decoded ids do not have the block's checksum")
    return ids


def _with_ends(ids: np.ndarray, begins: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The end id after each document; ids and each document's count."""
    return np.insert(ids, begins[1:], end_id), np.diff(begins) + 1


def _ids_job(path: str, end_id: int) -> ArrowJob:
    """Each document's ids, end id included, as bytes: two for each id, or four (``wide``) where one needs more."""

    def run(batches):
        for rows in slices(batches, limit=2 << 20):
            ids, lengths = _with_ends(*encoder(path).encode(rows.column("text")), end_id)
            wide = int(ids.max(initial=0) >= 1 << 16)
            raw = ids.astype("<u4" if wide else "<u2")
            cuts = np.concatenate(([0], np.cumsum(lengths))) * raw.itemsize
            held = binaries(raw.view(np.uint8), cuts).cast(pa.binary())
            kept = [rows.column(c) for c in ("doc_id", "head", "digest")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(np.full(rows.num_rows, wide, np.int32)), held], ["doc_id", "head", "digest", "wide", "ids"])

    return run


def _held_ids(rows: pa.RecordBatch) -> Iterator[tuple[np.ndarray, pa.RecordBatch]]:
    """The ids of a batch, and its rows; rows of two and of four bytes come apart, in order."""
    wide = rows.column("wide").to_numpy()
    borders = [0, *(np.flatnonzero(np.diff(wide)) + 1).tolist(), rows.num_rows]
    for a, b in zip(borders, borders[1:], strict=False):
        if a < b:
            part = rows.slice(a, b - a)
            raw = b"".join(part.column("ids").to_pylist())
            yield np.frombuffer(raw, "<u4" if wide[a] else "<u2").astype(np.uint32), part


def _count_job() -> ArrowJob:
    def run(batches):
        total = np.zeros(0, np.int64)
        for rows in batches:
            for ids, _ in _held_ids(rows):
                seen = np.bincount(ids)
                size = max(len(seen), len(total))
                total = np.pad(total, (0, size - len(total))) + np.pad(seen, (0, size - len(seen)))
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int32()), pa.array(total[hit], pa.int64())], ["symbol", "n"])

    return run


def _encode_job(table: Table) -> ArrowJob:
    def run(batches):
        from pyspark import TaskContext

        shard, block = TaskContext.get().partitionId(), 0
        held: list[tuple[np.ndarray, np.ndarray, list]] = []
        size = 0

        def flush():
            ids, lengths = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
            doc_ids = [d for h in held for d in h[2]]
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([block], pa.int32()), pa.array([len(ids)], pa.int64()), pa.array([doc_ids], pa.list_(pa.int64())),
                 pa.array([lengths.tolist()], pa.list_(pa.int64())), pa.array([encode(ids, table)], pa.binary())],
                ["shard", "block", "n_ids", "doc_ids", "lengths", "payload"],
            )

        for batch in batches:
            for rows in slices([batch], column="ids", limit=1 << 20):
                for ids, part in _held_ids(rows):
                    sizes = pc.binary_length(part.column("ids")).to_numpy() // (4 if part.column("wide")[0].as_py() else 2)
                    held.append((ids, sizes.astype(np.int64), part.column("doc_id").to_pylist()))
                    size += len(ids)
                    if size >= BLOCK_IDS:
                        yield flush()
                        held, size, block = [], 0, block + 1
        if held:
            yield flush()

    return run


def write_ids(docs: DataFrame, out: str, path: str, end_id: int = 0) -> None:
    """Write ``out``/frequencies and ``out``/blocks.

    Texts are encoded once, and their ids written, two bytes each.  The table of frequencies has a row for each
    symbol of the vocabulary, so it may reach the driver.  Ids move once, by ranges of the documents' ids; a
    range may begin inside the rows of one id, so that an id of many rows is several tasks'.
    """
    spark = docs.sparkSession
    rows = texts(docs).select("doc_id", F.substring("text", 1, HEAD).alias("head"), F.xxhash64("text").alias("digest"), "text")
    ids = materialize(rows.mapInArrow(tidy(_ids_job(path, end_id)), ID_ROWS), "document-ids")
    counted = ids.select("wide", "ids").mapInArrow(_count_job(), "symbol int, n long").groupBy("symbol").agg(F.sum("n").alias("n"))
    counted.write.parquet(f"{out}/frequencies")
    order = ["doc_id", "head", "digest", "nth"]
    ranged = ids.withColumn("nth", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.select("doc_id", "wide", "ids").mapInArrow(tidy(_encode_job(read_table(spark, out))), BLOCKS).write.parquet(f"{out}/blocks")


def read_table(spark: SparkSession, out: str) -> Table:
    counted = spark.read.parquet(f"{out}/frequencies").toArrow()
    if not counted.num_rows:
        return Table(np.zeros(0, np.uint64))
    symbols, n = counted.column("symbol").to_numpy(), counted.column("n").to_numpy()
    counts = np.zeros(int(symbols.max()) + 1, np.int64)
    counts[symbols] = n
    return Table(frequencies(counts))


def _decode_job(table: Table) -> ArrowJob:
    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                row = batch.slice(r, 1).to_pylist()[0]
                ids = decode(row["payload"], table).astype("<u4")
                lengths = np.array(row["lengths"], np.int64)
                ends = np.cumsum(lengths)
                raw = memoryview(ids.tobytes())
                crcs = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                k = len(lengths)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["shard"]] * k, pa.int32()), pa.array([row["block"]] * k, pa.int32()), pa.array(row["doc_ids"], pa.int64()),
                     pa.array(ends - lengths, pa.int64()), pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64())],
                    ["shard", "block", "doc_id", "inner", "n_tokens", "ids_crc32"],
                )

    return run


def read_digests(spark: SparkSession, out: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` decoded from the files; ``start`` counts the ids before."""
    blocks = spark.read.parquet(f"{out}/blocks")
    rows = blocks.mapInArrow(_decode_job(read_table(spark, out)), "shard int, block int, doc_id long, inner long, n_tokens long, ids_crc32 long")
    sizes = blocks.select("shard", "block", "n_ids")
    inner = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each file: the only window without a partition.
    files = sizes.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    files = files.select("shard", F.coalesce(F.sum("ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    places = sizes.withColumn("within", F.coalesce(F.sum("n_ids").over(inner), F.lit(0))).join(files, "shard")
    places = places.select("shard", "block", (F.col("before") + F.col("within")).alias("base"))
    return rows.join(places, ["shard", "block"]).select("doc_id", (F.col("base") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, path: str, end_id: int = 0) -> DataFrame:
    """Write the ids of all documents to the shared folder and give what the files hold."""
    out = scratch_path(docs.sparkSession, "token-ids")
    write_ids(docs, out, path, end_id)
    return read_digests(docs.sparkSession, out)
