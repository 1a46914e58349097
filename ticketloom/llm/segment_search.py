"""Exact top-k by inner product with segment statistics, coarse to fine.

A vector is cut into segments; each segment has a mean and a deviation.  By Cauchy's inequality the
inner product of two vectors is at most the sum over segments of
``length * (mean * mean + deviation * deviation)``, which is the same as a lower bound on their
distance, as |q - c|^2 = |q|^2 + |c|^2 - 2qc.  One segment is tried first, then more and shorter
ones; only pairs whose bound still reaches the query's k-th best score are scored exactly, in
integers.

Vectors are packed into blocks.  Each query group meets each slice of blocks in one task, which
carries the k best so far from block to block; a bounded sample of the table gives the first floor.
No pair becomes a row: a task returns k rows for each query at most.

Components are ``floor(scale * x)``.  A vector takes no part if it or its id is null, or if a component is null
or not finite, after scaling too.  Vectors with a component beyond ``LARGEST`` form blocks of their own: bounds
see their rows divided by a power of two, and survivors that could leave 64 bits are scored in Python's integers.
A score beyond 64 bits is reported, and ranked, as plus or minus ``MOST``.  Only vectors of the same length are
compared.  A row is never its own candidate, nor is any row of the same id; a query row that is there twice is
answered twice; equal scores go to the smaller id.  Empty tables and queries without a candidate give no row.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketloom.llm.tables import materialize

BLOCK_ROWS = 8192
QUERY_ROWS = 256  # queries whose bounds are held at once
LARGEST = 1 << 24  # components up to here are held in 32 bits, larger ones as doubles
MOST = (1 << 63) - 1
LARGE_PAIRS = 4096  # pairs that are scored at once in Python's integers
SPARSE = 16  # one pair in so many is open: from there on pairs are looked at one by one
BLOCK = "block long, dim int, n long, ids binary, vectors binary"
QUERIES = "block long, dim int, ids binary, vectors binary, floors binary"
FOUND = "block long, nth int, query_id long, vec_id long, score long"
NO_FLOOR = np.iinfo(np.int64).min


def quantised(column: pa.Array, ids: pa.Array, scale: float) -> dict[tuple[int, bool], tuple[np.ndarray, np.ndarray]]:
    """By length, and whether a component is beyond ``LARGEST``: ids and whole-numbered vectors of the rows that take part."""
    lists = column.cast(pa.large_list(pa.float64()))
    sizes = pc.fill_null(pc.list_value_length(lists), -1).to_numpy(zero_copy_only=False)
    ids_ok = pc.is_valid(ids).to_numpy(zero_copy_only=False)
    out = {}
    for dim in np.unique(sizes[sizes >= 0]).tolist():
        rows = np.flatnonzero((sizes == dim) & ids_ok)
        taken = lists.take(pa.array(rows))
        flat = pc.fill_null(taken.flatten(), float("nan")).to_numpy(zero_copy_only=False).reshape(len(rows), dim)
        with np.errstate(invalid="ignore", over="ignore"):
            scaled = np.floor(scale * flat)
            good = np.isfinite(scaled).all(axis=1)
            large = ~np.all(np.abs(scaled) <= LARGEST, axis=1)
        for wide, kind in ((False, np.int64), (True, np.float64)):
            kept = good & (large == wide)
            if kept.any():
                out[dim, wide] = (ids.take(pa.array(rows[kept])).to_numpy(), scaled[kept].astype(kind))
    return out


def _blocks_job(scale: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        held: dict[tuple[int, bool], list] = {}

        def flush(key):
            dim, wide = key
            ids, vectors = (np.concatenate(x) for x in zip(*held.pop(key), strict=True))
            return pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([dim], pa.int32()), pa.array([len(ids)], pa.int64()), pa.array([ids.astype("<i8").tobytes()], pa.binary()), pa.array([vectors.astype("<f8" if wide else "<i4").tobytes()], pa.binary())],
                ["block", "dim", "n", "ids", "vectors"],
            )

        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                for key, rows in quantised(part.column("embedding"), part.column("vec_id"), scale).items():
                    held.setdefault(key, []).append(rows)
                    if sum(len(h[0]) for h in held[key]) >= BLOCK_ROWS:
                        yield flush(key)
                        block += 1
        for key in list(held):
            yield flush(key)
            block += 1

    return run


def segment_counts(dim: int) -> list[int]:
    """1, 4, 16, ... segments of three components at least, and one level of two components."""
    out, n = [], 1
    while n * 2 < dim:
        out.append(n)
        n *= 4
    return out + [dim // 2] * (dim > 1)


def statistics(vectors: np.ndarray, segments: int) -> np.ndarray:
    """For each segment its mean and deviation, both times the root of its length: bounds are inner products of these rows."""
    dim = vectors.shape[1]
    begins = np.arange(segments) * dim // segments
    lengths = np.diff(np.append(begins, dim))
    sums = np.add.reduceat(vectors, begins, axis=1).astype(np.float64)
    # Squares about the mean: the difference of two large sums would lose small deviations.
    about = vectors - np.repeat(sums / lengths, lengths, axis=1)
    return np.hstack((sums / np.sqrt(lengths), np.sqrt(np.add.reduceat(about * about, begins, axis=1))))


class Side:
    """Vectors of one side with their statistics on every level.

    Rows of doubles are divided by ``2 ** power`` first, so that no square leaves their range.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors, self.power = ids, vectors, None
        if vectors.dtype.kind == "f":
            self.power = np.frexp(np.abs(vectors).max(axis=1, initial=0.0))[1].astype(np.int64)
            vectors = np.ldexp(vectors, -self.power[:, None])
        self.levels = [statistics(vectors, s) for s in segment_counts(vectors.shape[1])]
        self.norm = np.sqrt((vectors * vectors).sum(1).astype(np.float64))

    def part(self, a: int, b: int) -> Side:
        out = object.__new__(Side)
        out.ids, out.vectors, out.norm = self.ids[a:b], self.vectors[a:b], self.norm[a:b]
        out.power = None if self.power is None else self.power[a:b]
        out.levels = [x[a:b] for x in self.levels]
        return out


def _dots(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    out = np.empty(len(i), np.result_type(a, b))
    for at in range(0, len(i), 1 << 16):
        s = slice(at, at + (1 << 16))
        out[s] = np.einsum("ij,ij->i", a[i[s]], b[j[s]])
    return out


def _large_dots(queries: Side, corpus: Side, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Scores of the pairs in whole numbers of any size, cut off at ``MOST``."""
    out = np.empty(len(i), np.int64)
    whole = np.vectorize(int, otypes=[object])
    for at in range(0, len(i), LARGE_PAIRS):
        s = slice(at, at + LARGE_PAIRS)
        rows, of_row = np.unique(i[s], return_inverse=True)
        others, of_other = np.unique(j[s], return_inverse=True)
        a, b = whole(queries.vectors[rows]), whole(corpus.vectors[others])
        out[s] = [min(MOST, max(-MOST, x)) for x in (a[of_row] * b[of_other]).sum(axis=1)]
    return out


def _large_survivors(queries: Side, corpus: Side, floors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As :func:`scored_survivors` where a side holds large components: bounds and floors are compared after division."""
    powers = [np.zeros(len(x.ids), np.int64) if x.power is None else x.power for x in (queries, corpus)]
    reach = np.where(floors == NO_FLOOR, -np.inf, floors.astype(np.float64))
    least = np.ldexp(reach[:, None], -(powers[0][:, None] + powers[1])) - 1e-9 * queries.norm[:, None] * corpus.norm
    open_ = np.ones(least.shape, bool)
    for a, b in zip(queries.levels, corpus.levels, strict=True):
        open_ &= a @ b.T >= least
    i, j = np.nonzero(open_)
    scores = _large_dots(queries, corpus, i, j)
    kept = (scores >= floors[i]) & (queries.ids[i] != corpus.ids[j])
    return i[kept], j[kept], scores[kept]


def scored_survivors(queries: Side, corpus: Side, floors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, candidate, score) of the pairs whose bounds on all levels and whose score reach the query's floor.

    Few survivors are scored one by one; where the bounds leave many, as one product of the blocks, in
    floating point only while every score is a whole number below 2^53.
    """
    if queries.power is not None or corpus.power is not None:
        return _large_survivors(queries, corpus, floors)
    reach = np.where(floors == NO_FLOOR, -np.inf, floors.astype(np.float64))
    # Bounds are floating-point: a little below the floor still counts as reaching it.
    least = reach - (1e-9 * queries.norm * corpus.norm.max(initial=1.0) + 1e-6)
    size = len(least) * len(corpus.ids)
    open_, i, j = np.ones((len(least), len(corpus.ids)), bool), None, None
    for a, b in zip(queries.levels, corpus.levels, strict=True):
        if i is None:
            # While many pairs are open, all bounds of a level are one matrix product.
            open_ &= a @ b.T >= least[:, None]
            if np.count_nonzero(open_) * SPARSE <= size:
                i, j = np.nonzero(open_)
        else:
            kept = _dots(a, b, i, j) >= least[i]
            i, j = i[kept], j[kept]
    if i is not None:
        scores = _dots(queries.vectors, corpus.vectors, i, j)
        kept = scores >= floors[i]
        i, j, scores = i[kept], j[kept], scores[kept]
    else:
        exact = queries.norm.max(initial=0.0) * corpus.norm.max(initial=0.0) < 2.0**52
        products = queries.vectors.astype(np.float64) @ corpus.vectors.T.astype(np.float64) if exact else queries.vectors @ corpus.vectors.T
        i, j = np.nonzero(open_ & (products >= (reach[:, None] if exact else floors[:, None])))
        scores = products[i, j].astype(np.int64)
    own = queries.ids[i] == corpus.ids[j]
    return i[~own], j[~own], scores[~own]


def _best(i: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores, i))
    i, ids, scores = i[order], ids[order], scores[order]
    heads = np.searchsorted(i, i)
    keep = np.arange(len(i)) - heads < k
    return i[keep], ids[keep], scores[keep]


def search(queries: Side, blocks: Iterator[Side], floors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, id, score) of the k best of all blocks that reach the floors; floors rise as blocks pass."""
    floors = floors.copy()
    best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    for corpus in blocks:
        i, j, scores = scored_survivors(queries, corpus, floors)
        best = _best(*(np.concatenate(x) for x in zip(best, (i, corpus.ids[j], scores), strict=True)), k)
        full = np.flatnonzero(np.bincount(best[0], minlength=len(floors)) >= k)
        last = np.searchsorted(best[0], full, side="right") - 1
        floors[full] = np.maximum(floors[full], best[2][last])
    return best


def _stored(vectors: bytes, rows: int, dim: int) -> np.ndarray:
    """Rows as a block holds them: 32-bit integers, or doubles."""
    return np.frombuffer(vectors, "<f8" if len(vectors) == 8 * rows * dim > 0 else "<i4").reshape(rows, dim)


def _unpacked(ids: bytes, vectors: bytes, dim: int) -> Side:
    held = np.frombuffer(ids, "<i8")
    rows = _stored(vectors, len(held), dim)
    return Side(held, rows if rows.dtype.kind == "f" else rows.astype(np.int64))


def _queries_job(every: int, k: int, sample: dict[tuple[int, bool], tuple[np.ndarray, np.ndarray]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        seeds: dict[int, list[Side]] = {}
        for (dim, _), rows in sample.items():
            seeds.setdefault(dim, []).append(Side(*rows))
        for batch in batches:
            for r in batch.to_pylist():
                ids = np.frombuffer(r["ids"], "<i8")
                asked = np.flatnonzero(ids % every == 0)
                if not len(asked):
                    continue
                vectors = _stored(r["vectors"], len(ids), r["dim"])[asked]
                whole = vectors if vectors.dtype.kind == "f" else vectors.astype(np.int64)
                floors = np.full(len(asked), NO_FLOOR, np.int64)
                if r["dim"] in seeds:
                    for at in range(0, len(asked), QUERY_ROWS):
                        side = Side(ids[asked][at : at + QUERY_ROWS], whole[at : at + QUERY_ROWS])
                        i, _, scores = search(side, iter(seeds[r["dim"]]), floors[at : at + QUERY_ROWS], k)
                        full = np.flatnonzero(np.bincount(i, minlength=len(side.ids)) >= k)
                        floors[at + full] = scores[np.searchsorted(i, full, side="right") - 1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["block"]], pa.int64()), pa.array([r["dim"]], pa.int32()), pa.array([ids[asked].tobytes()], pa.binary()), pa.array([vectors.tobytes()], pa.binary()), pa.array([floors.astype("<i8").tobytes()], pa.binary())],
                    ["block", "dim", "ids", "vectors", "floors"],
                )

    return run


def _cell_job(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(queries: pa.Table, corpus: pa.Table) -> pa.Table:
        blocks = [_unpacked(c["ids"], c["vectors"], c["dim"]) for c in corpus.to_pylist()]
        out: list[tuple[np.ndarray, ...]] = []
        for q in queries.to_pylist() if blocks else []:
            whole, floors = _unpacked(q["ids"], q["vectors"], q["dim"]), np.frombuffer(q["floors"], "<i8")
            for at in range(0, len(whole.ids), QUERY_ROWS):
                i, ids, scores = search(whole.part(at, at + QUERY_ROWS), iter(blocks), floors[at : at + QUERY_ROWS], k)
                out.append((np.full(len(i), q["block"]), at + i, whole.ids[at + i], ids, scores))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 5
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        return pa.table([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], ["block", "nth", "query_id", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, every: int = 20, k: int = 20, scale: float = 64.0, slice_rows: int = 1 << 14, group_rows: int = 1 << 14, seed_rows: int = 2048) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row whose id is divisible by ``every`` its ``k`` best others.

    A query group holds about ``group_rows`` queries and a slice about ``slice_rows`` candidates; both
    bound a task's memory.  ``seed_rows`` vectors reach the driver.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    blocks = materialize(rows.mapInArrow(_blocks_job(scale), BLOCK), "vector-blocks")
    seed = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(seed_rows).toArrow()
    sample = quantised(seed.column("embedding").combine_chunks(), seed.column("vec_id").combine_chunks(), scale) if seed.num_rows else {}
    asked = materialize(blocks.mapInArrow(_queries_job(every, k, sample), QUERIES), "query-blocks")
    n = blocks.agg(F.sum("n")).first()[0] or 0
    n_asked = asked.agg(F.sum(F.octet_length("ids") / 8)).first()[0] or 0
    slices, groups = max(1, math.ceil(n / slice_rows)), max(1, math.ceil(n_asked / group_rows))

    def dealt(df: DataFrame, own: str, parts: int, other: str, others: int) -> DataFrame:
        return df.withColumn(own, F.pmod(F.xxhash64("block"), F.lit(parts))).withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(others - 1).cast("long"))))

    left = dealt(asked, "g", groups, "s", slices).groupBy("dim", "g", "s")
    right = dealt(blocks, "s", slices, "g", groups).groupBy("dim", "g", "s")
    found = left.cogroup(right).applyInArrow(_cell_job(k), FOUND)
    best = Window.partitionBy("block", "nth").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
