"""Packing by the linear grouping scheme, finished by best fit.

Documents longer than a sequence are cut into full pieces, the rest of the division first.  Pieces
are dealt to groups at random (a hash of the piece), and each group is packed alone, from lengths:

* pieces of more than ``room / SMALL`` ids are large.  Sorted, they fall into ``CLASSES`` classes of
  equal cardinality, and each length is rounded up to the largest of its class;
* with so few sizes, the ways to fill one sequence ("configurations") are chosen by the linear
  program of Gilmore and Gomory: columns come from a knapsack over the duals until Farley's bound
  shows that no more than half a sequence can be won.  Whole parts of the solution are used, and of
  the fractions those whose classes still have pieces;
* actual pieces take the places of their rounded lengths, the longest first;
* what is left, large rests and small pieces, goes by best fit in descending length into the room
  that rounding left, then into new sequences.

A null text counts as empty: its one piece is the end id.  Rows may repeat and share ids; each row
has its own pieces.  An empty table gives no piece.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.arrays import ArrowJob, encoder, slices, tidy, tidy_group
from ticketloom.llm.tables import materialize, texts

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
GROUP_PIECES = 1 << 16
CLASSES = 32
SMALL = 8
SLICE = 2 << 20


def cut(n_ids: int, room: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; the first alone may be shorter than ``room``."""
    first = n_ids % room or room
    if n_ids <= room:
        return [(0, n_ids)]
    return [(0, first)] + [(at, room) for at in range(first, n_ids, room)]


def _cut_job(path: str, end_id: int, room: int) -> ArrowJob:
    def run(batches):
        for rows in slices(batches, limit=SLICE):
            ids, begins = encoder(path).encode(rows.column("text"))
            ids, lengths = np.insert(ids, begins[1:], end_id), np.diff(begins) + 1
            raw = memoryview(ids.astype("<u4").tobytes())
            out, begin = [], 0
            for doc_id, n in zip(rows.column("doc_id").to_pylist(), lengths.tolist(), strict=True):
                for k, (start, length) in enumerate(cut(n, room)):
                    at = begin + start
                    out.append((doc_id, k, start, length, zlib.crc32(raw[4 * at : 4 * (at + length)])))
                begin += n
            columns = list(zip(*out, strict=True))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def pieces(docs: DataFrame, path: str, end_id: int = 2, room: int = 1024) -> DataFrame:
    """The pieces of all documents with the crc32 of their ids; one pass, no shuffle."""
    return texts(docs).mapInArrow(tidy(_cut_job(path, end_id, room)), PIECES)


def rounded_up(lengths: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """For lengths in descending order the class of each, and each class's size, descending too.

    Classes hold equally many lengths; classes of one size are one class.
    """
    n = len(lengths)
    begins = np.arange(min(classes, n), dtype=np.int64) * n // max(1, min(classes, n))
    sizes, first = np.unique(-lengths[begins], return_index=True)
    return np.searchsorted(begins[first], np.arange(n), side="right") - 1, -sizes


def _best_configuration(worth: np.ndarray, sizes: np.ndarray, room: int) -> np.ndarray:
    """How many of each size fill a sequence at the greatest worth (an unbounded knapsack)."""
    value, last = np.zeros(room + 1), np.full(room + 1, -1, np.int64)
    for free in range(int(sizes.min()), room + 1):
        fits = free - sizes
        with_each = np.where(fits >= 0, value[fits] + worth, -1.0)
        k = int(with_each.argmax())
        if with_each[k] > value[free - 1] + 1e-12:
            value[free], last[free] = with_each[k], k
        else:
            value[free], last[free] = value[free - 1], -2
    counts, free = np.zeros(len(sizes), np.int64), room
    while free > 0 and last[free] != -1:
        if last[free] == -2:
            free -= 1
        else:
            counts[last[free]] += 1
            free -= sizes[last[free]]
    return counts


def configurations(sizes: np.ndarray, demand: np.ndarray, room: int, rounds: int = 5000) -> tuple[np.ndarray, np.ndarray]:
    """Configurations (one a row) and how often to use each so that the demand is met with least sequences.

    The solution is that of the linear program, to within half a sequence; ``rounds`` only guards
    against cycling.
    """
    m = len(sizes)
    columns = np.diag(room // sizes).astype(np.float64)  # each size alone
    inverse = np.diag(1.0 / np.diag(columns))
    used = inverse @ demand
    for _ in range(rounds):
        worth = np.maximum(inverse.sum(axis=0), 0.0)
        new = _best_configuration(worth, sizes, room)
        value = float(worth @ new)
        if value <= 1 + 1e-9 or used.sum() - used.sum() / value < 0.5:
            break
        step = inverse @ new
        limit = np.where(step > 1e-9, used / np.where(step > 1e-9, step, 1.0), np.inf)
        leaves = int(limit.argmin())
        columns[:, leaves] = new
        pivot = inverse[leaves] / step[leaves]
        inverse -= np.outer(step, pivot)
        inverse[leaves] = pivot
        used = np.maximum(inverse @ demand, 0.0)
    return columns.T.astype(np.int64).reshape(m, m), used


def _best_fit(lengths: np.ndarray, free: list[int], room: int) -> tuple[list[int], list[int]]:
    """The sequence of each length, taken in descending order: the fullest that has room, or a new one.

    ``free`` holds the room of open sequences and grows with new ones; ties go to the latest.
    """
    with_room: list[list[int]] = [[] for _ in range(room + 1)]
    some = 0
    for b, n in enumerate(free):
        with_room[n].append(b)
        some |= 1 << n
    bins, offsets = [0] * len(lengths), [0] * len(lengths)
    order = np.argsort(-lengths, kind="stable")
    for i, n in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fitting = some >> n
        if fitting:
            left = n + (fitting & -fitting).bit_length() - 1
            b = with_room[left].pop()
            if not with_room[left]:
                some &= ~(1 << left)
        else:
            b, left = len(free), room
            free.append(room)
        bins[i], offsets[i] = b, room - left
        free[b] = left - n
        with_room[left - n].append(b)
        some |= 1 << (left - n)
    return bins, offsets


def pack_lengths(lengths: np.ndarray, room: int, classes: int = CLASSES, small: int = SMALL) -> tuple[np.ndarray, np.ndarray]:
    """The sequence and the offset in it of each piece; see the module's text."""
    n = len(lengths)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    full = np.flatnonzero(lengths == room)
    bins[full] = np.arange(len(full))
    open_ = np.flatnonzero(lengths < room)
    large = open_[lengths[open_] * small > room]
    large = large[np.argsort(-lengths[large], kind="stable")]
    placed = np.zeros(n, bool)
    placed[full] = True
    free: list[int] = []
    if len(large):
        kind, sizes = rounded_up(lengths[large], classes)
        begins = np.searchsorted(kind, np.arange(len(sizes) + 1))
        demand = np.diff(begins)
        shapes, used = configurations(sizes, demand.astype(np.float64), room)
        taken = np.zeros(len(sizes), np.int64)
        times = np.floor(used + 1e-7).astype(np.int64)
        for c in np.argsort(times - used, kind="stable").tolist() * 2:  # large fractions first; a second turn for what is left
            shape = shapes[c]
            held = np.flatnonzero(shape)
            left = demand - taken
            fits = int((left[held] // shape[held]).min(initial=0)) if len(held) else 0
            k = min(fits, int(times[c]))
            times[c] = 1 if k == times[c] else 0  # then one more for the fraction, if its pieces are there
            if k <= 0:
                continue
            first = len(free)
            filled = np.zeros(k, np.int64)
            for s in held.tolist():
                for _ in range(int(shape[s])):
                    some = large[begins[s] + taken[s] : begins[s] + taken[s] + k]
                    taken[s] += k
                    bins[some], offsets[some], placed[some] = first + np.arange(k), filled, True
                    filled += lengths[some]
            free += (room - filled).tolist()
    rest = np.flatnonzero(~placed)
    at, offset = _best_fit(lengths[rest], free, room)
    bins[rest], offsets[rest] = at, offset
    bins[open_] += len(full)
    return bins, offsets


def _pack_job(room: int, classes: int, small: int) -> Callable[[pa.Table], pa.Table]:
    def run(group: pa.Table) -> pa.Table:
        # The order in which rows arrive differs between runs; the result must not.
        group = group.sort_by([(c, "ascending") for c in ("length", "doc_id", "piece", "ids_crc32")])
        bins, offsets = pack_lengths(group.column("length").to_numpy(), room, classes, small)
        first = group.column("grp")[0].as_py() << 32
        kept = group.drop_columns(["grp"])
        return kept.append_column("sequence_id", pa.array(first + bins, pa.int64())).append_column("offset", pa.array(offsets, pa.int64()))

    return run


def pack(docs: DataFrame, path: str, end_id: int = 2, room: int = 1024, classes: int = CLASSES, small: int = SMALL, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece.

    The pieces are written once, so that texts are encoded once; their count gives the number of
    groups.  Piece rows, not ids, are shuffled, by a hash that copies of one row do not share.
    """
    cutting = materialize(pieces(docs, path, end_id, room), "pieces")
    groups = max(1, math.ceil(cutting.count() / group_pieces))
    # Copies of a row differ in the random part; it comes from the row's place in the written table.
    dealt = cutting.withColumn("grp", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()), F.lit(groups)))
    return dealt.groupBy("grp").applyInArrow(tidy_group(_pack_job(room, classes, small)), f"{PIECES}, sequence_id long, offset long")
