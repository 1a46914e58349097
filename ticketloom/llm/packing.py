"""First-fit decreasing with a tournament tree of bin capacities, in randomised groups.

Every document is cut into pieces: full sequences, and a rest.  A rest longer than ``largest`` is cut
once more, since items of at most half a bin leave first-fit decreasing almost no waste.  Pieces
are dealt to groups at random (a hash of the piece), and each group is packed alone, from its
lengths: a tree over the bins holds the largest free room below each node, so the first bin that
takes a piece is found in logarithmic time.

A null text counts as empty: its one piece is the end id.  Rows may repeat and share ids; each row
has its own pieces.  An empty table gives no piece.  Only the last bins of a group are not full.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.arrays import encoder, slices, tidy, tidy_group
from ticketloom.llm.rans import _with_ends
from ticketloom.llm.tables import materialize, texts

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
GROUP_PIECES = 1 << 15


def cut(n_ids: int, room: int, largest: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces."""
    full, rest = divmod(n_ids, room)
    out = [(k * room, room) for k in range(full)]
    if rest > largest:
        out.append((full * room, largest))
        out.append((full * room + largest, rest - largest))
    elif rest:
        out.append((full * room, rest))
    return out


def first_fit_decreasing(lengths: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """The bin and the offset in it of each piece."""
    order = np.argsort(-lengths, kind="stable")
    size = 1 << max(0, math.ceil(math.log2(max(1, len(lengths)))))
    free = [room] * (2 * size)
    filled = [0] * size
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i, n in zip(order.tolist(), lengths[order].tolist(), strict=True):
        node = 1
        while node < size:
            node *= 2
            if free[node] < n:
                node += 1
        at = node - size
        bins[i], offsets[i] = at, filled[at]
        filled[at] += n
        free[node] -= n
        while node > 1:
            node //= 2
            most = max(free[2 * node], free[2 * node + 1])
            if free[node] == most:
                break
            free[node] = most
    return bins, offsets


def _cut_job(path: str, end_id: int, room: int, largest: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        for rows in slices(batches, limit=2 << 20):
            ids, lengths = _with_ends(*encoder(path).encode(rows.column("text")), end_id)
            raw = memoryview(ids.astype("<u4").tobytes())
            out = []
            begin = 0
            for doc_id, n in zip(rows.column("doc_id").to_pylist(), lengths.tolist(), strict=True):
                for start, length in cut(n, room, largest):
                    at = begin + start
                    out.append((doc_id, start, length, zlib.crc32(raw[4 * at : 4 * (at + length)]), n))
                begin += n
            columns = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return run


def pieces(docs: DataFrame, path: str, end_id: int = 1, room: int = 2048, largest: int = 1024) -> DataFrame:
    """The pieces of all documents with the crc32 of their ids; one pass, no shuffle."""
    if not 0 < largest <= room:
        raise ValueError("largest must lie between 1 and room")
    return texts(docs).mapInArrow(tidy(_cut_job(path, end_id, room, largest)), PIECES)


def _pack_job(room: int) -> Callable[[pa.Table], pa.Table]:
    def run(group: pa.Table) -> pa.Table:
        bins, offsets = first_fit_decreasing(group.column("length").to_numpy(), room)
        first = group.column("grp")[0].as_py() << 32
        kept = group.drop_columns(["grp"])
        return kept.append_column("sequence_id", pa.array(first + bins, pa.int64())).append_column("offset", pa.array(offsets, pa.int64()))

    return run


def pack(docs: DataFrame, path: str, end_id: int = 1, room: int = 2048, largest: int = 1024, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` of every piece.

    The pieces are written once, so that texts are encoded once; their count gives the number of
    groups.  Piece rows, not ids, are shuffled, by a hash that copies of one row do not share.
    """
    cutting = materialize(pieces(docs, path, end_id, room, largest), "pieces")
    groups = max(1, math.ceil(cutting.count() / group_pieces))
    # Copies of a row differ in the random part; it comes from the row's place in the written table.
    dealt = cutting.withColumn("grp", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", F.monotonically_increasing_id()), F.lit(groups)))
    return dealt.groupBy("grp").applyInArrow(tidy_group(_pack_job(room)), f"{PIECES}, sequence_id long, offset long")
