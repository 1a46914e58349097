"""Exact nearest neighbours by inner product, label votes and reranking.

Scores are ranked after rounding to nine decimals, best first and then by id: matrix products of
different block shapes differ in the last bits, and identical vectors must tie whatever block they
fall into.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketloom.functions.vectors import clamp01
from ticketloom.operators.cells import MAX_PIVOTS, Cells, assign, distinct_rows
from ticketloom.scale import hot_keys, materialize, salted_join
from ticketloom.settings import DEFAULTS

SCORE_DIGITS = 9
# Largest side that is shipped to every executor, in bytes of float64.
BROADCAST_BYTES = 64 << 20
# Bytes of float64 that one task holds of the corpus when neither side is small enough; it holds four
# times as much of the queries, as a cell is sent once for each such part of the queries that need it.
BLOCK_BYTES = 64 << 20
# A group's queries become a matrix in slices of this part of a block.
QUERY_SLICES = 8
# Cells of one score matrix: 32 MiB of float64.
SCORE_CELLS = 4 << 20


@dataclass
class _Side:
    ids: np.ndarray
    matrix: np.ndarray
    extra: pa.Table


def _side(batch: pa.Table, id_col: str, vec_col: str, extra: Sequence[str]) -> _Side:
    table = batch.combine_chunks()
    rows = table.num_rows
    lists = table.column(vec_col)
    flat = (lists.chunk(0) if lists.num_chunks else pa.array([], lists.type)).flatten()
    sizes = pc.list_value_length(lists).to_numpy() if rows else np.zeros(0, np.int64)
    width = int(sizes[0]) if rows else 0
    odd = np.flatnonzero(sizes != width)
    if len(odd):
        raise ValueError(f"vectors in {vec_col} differ in length: {width} and {int(sizes[odd[0]])} at {id_col} {table.column(id_col)[int(odd[0])].as_py()}")
    matrix = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, width)
    ids = table.column(id_col).to_numpy()
    if ids.dtype == object:
        ids = ids.astype(str)
    return _Side(ids, matrix, table.select([id_col, *extra]))


class _Best:
    """The k best candidates of each query seen so far."""

    def __init__(self, queries: _Side, k: int):
        self.queries, self.k = queries, k
        self.query = np.empty(0, np.int64)
        self.score = np.empty(0)
        self.ids: np.ndarray | None = None
        self.rank = np.empty(0, np.int64)
        self.extra: pa.Table | None = None
        self.floor = np.full(len(queries.ids), -np.inf)

    def offer(self, corpus: _Side) -> None:
        n = len(corpus.ids)
        if not n or not len(self.queries.ids):
            return
        step = max(1, SCORE_CELLS // n)
        found_q, found_c, found_s = [], [], []
        for start in range(0, len(self.queries.ids), step):
            scores = np.round(self.queries.matrix[start:start + step] @ corpus.matrix.T, SCORE_DIGITS)
            least = self.floor[start:start + step]
            if n > self.k:
                # The k-th best score, kept with all that tie with it: ids decide below.
                least = np.maximum(least, np.partition(scores, n - self.k, axis=1)[:, n - self.k])
            q, c = np.nonzero(scores >= least[:, None])
            found_q.append(q + start)
            found_c.append(c)
            found_s.append(scores[q, c])
        c = np.concatenate(found_c)
        new_ids = corpus.ids[c]
        query = np.concatenate([self.query, *found_q])
        score = np.concatenate([self.score, *found_s])
        ids = new_ids if self.ids is None else np.concatenate([self.ids, new_ids])
        order = np.lexsort((ids, -score, query))
        sorted_q = query[order]
        first = np.concatenate([[True], sorted_q[1:] != sorted_q[:-1]])
        place = np.arange(len(order))
        place = place - np.maximum.accumulate(np.where(first, place, 0))
        kept = order[place < self.k]
        old = 0 if self.extra is None else self.extra.num_rows
        pool = corpus.extra.take(pa.array(c[kept[kept >= old] - old])) if old else corpus.extra.take(pa.array(c[kept]))
        if old:
            # Old rows first, then new ones; the arrays follow the same order.
            stay, come = kept[kept < old], kept[kept >= old]
            ranks = place[place < self.k]
            self.rank = np.concatenate([ranks[kept < old], ranks[kept >= old]])
            self.extra = pa.concat_tables([self.extra.take(pa.array(stay)), pool])
            kept = np.concatenate([stay, come])
        else:
            self.rank = place[place < self.k]
            self.extra = pool
        self.query, self.score, self.ids = query[kept], score[kept], ids[kept]
        last = self.rank == self.k - 1
        self.floor[self.query[last]] = self.score[last]

    def table(self, schema: pa.Schema) -> pa.Table:
        if self.extra is None:
            return schema.empty_table()
        left = self.queries.extra.take(pa.array(self.query))
        columns = [*left.columns, pa.array(self.rank + 1, pa.int32()), self.extra.column(0), pa.array(self.score)]
        columns += self.extra.columns[1:]
        return pa.Table.from_arrays(
            [c.cast(f.type) for c, f in zip(columns, schema)], schema=schema
        )


def _sliced(
    asked: pa.Table, held: _Side, k: int, id_col: str, vec_col: str, extra: Sequence[str], block_bytes: int, arrow: pa.Schema
) -> Iterator[pa.Table]:
    """Candidates of a group's queries.  They stay as they came, in single precision, but for a slice at a time."""
    rows = max(1, block_bytes // QUERY_SLICES // (8 * max(1, held.matrix.shape[1])))
    step = max(1, SCORE_CELLS // max(1, min(rows, asked.num_rows)))
    for start in range(0, asked.num_rows, rows):
        some = asked.slice(start, rows)
        best = _Best(_side(some, id_col, vec_col, extra), k)
        best.floor = some.column("_floor").to_numpy().astype(np.float64).copy()
        for at in range(0, len(held.ids), step):
            best.offer(_Side(held.ids[at:at + step], held.matrix[at:at + step], held.extra.slice(at, step)))
        yield best.table(arrow)


def _result_schema(
    queries: DataFrame, corpus: DataFrame, id_col: str, query_extra: Sequence[str], corpus_extra: Sequence[str]
) -> T.StructType:
    fields = [T.StructField("query_id", queries.schema[id_col].dataType)]
    fields += [T.StructField(c, queries.schema[c].dataType) for c in query_extra]
    fields += [
        T.StructField("rank", T.IntegerType()),
        T.StructField("neighbor_id", corpus.schema[id_col].dataType),
        T.StructField("score", T.DoubleType()),
    ]
    fields += [T.StructField(f"neighbor_{c}", corpus.schema[c].dataType) for c in corpus_extra]
    return T.StructType(fields)


def nearest(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = DEFAULTS.top_k,
    id_col: str = "ticket_id",
    vec_col: str = "embedding",
    corpus_extra: Sequence[str] = ("queue",),
    query_extra: Sequence[str] = (),
    broadcast_bytes: int = BROADCAST_BYTES,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The k corpus vectors of largest inner product with each query; fewer if the corpus has fewer.

    Both sides are sized first.  A corpus that fits ``broadcast_bytes`` goes to every executor and
    queries stream past it without a shuffle.  Else, if the queries fit, they go out and each
    corpus partition keeps k candidates per query, merged by a top-k window.  Else the corpus is
    cut into cells around sampled vectors, and a query is sent only to cells whose bound reaches
    the k-th best score of the cells it asked first.  All three are exact, and no pair of vectors
    is ever a row.

    A vector that is null or holds a null, NaN or infinite element takes no part on either side;
    vectors of different lengths are an error that names the id.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = queries.sparkSession
    finite = F.col(vec_col).isNotNull() & F.forall(vec_col, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    q = queries.where(finite).select(id_col, vec_col, *query_extra)
    c = corpus.where(finite).select(id_col, vec_col, *corpus_extra)
    schema = _result_schema(q, c, id_col, query_extra, corpus_extra)
    arrow = to_arrow_schema(schema)

    # The widest vector and the bytes of what travels beside it; one job for both sides.
    def counted(df: DataFrame, side: str, extra: Sequence[str]) -> DataFrame:
        beside = sum((F.coalesce(F.octet_length(F.col(x).cast("string")), F.lit(0)) for x in extra), F.lit(8))
        return df.agg(F.lit(side).alias("side"), F.count(F.lit(1)).alias("rows"), F.max(F.size(vec_col)).alias("width"), F.sum(beside).alias("beside"))

    measured = counted(queries, "q", query_extra).unionByName(counted(corpus, "c", corpus_extra)).collect()
    size = {side: 8 * n * max(1, width or 0) + (beside or 0) for side, n, width, beside in measured}
    fits = {side: n <= broadcast_bytes for side, n in size.items()}

    if fits["c"]:
        shared = spark.sparkContext.broadcast(c.toArrow())

        def scan_queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = _side(shared.value, id_col, vec_col, corpus_extra)
            for batch in batches:
                best = _Best(_side(pa.Table.from_batches([batch]), id_col, vec_col, query_extra), k)
                step = max(1, SCORE_CELLS // max(1, batch.num_rows))
                for start in range(0, len(held.ids), step):
                    best.offer(
                        _Side(held.ids[start:start + step], held.matrix[start:start + step], held.extra.slice(start, step))
                    )
                yield from best.table(arrow).to_batches()

        return q.mapInArrow(scan_queries, schema)

    if fits["q"]:
        shared = spark.sparkContext.broadcast(q.toArrow())

        def scan_corpus(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = _Best(_side(shared.value, id_col, vec_col, query_extra), k)
            for batch in batches:
                best.offer(_side(pa.Table.from_batches([batch]), id_col, vec_col, corpus_extra))
            yield from best.table(arrow).to_batches()

        partial = c.mapInArrow(scan_corpus, schema)
    else:
        partial = _by_cells(q, c, k, id_col, vec_col, query_extra, corpus_extra, schema, block_bytes, size["c"])

    return top_k(partial, k, "query_id", [F.desc("score"), F.asc("neighbor_id")]).select(schema.names)


def _by_cells(
    q: DataFrame, c: DataFrame, k: int, id_col: str, vec_col: str, query_extra: Sequence[str], corpus_extra: Sequence[str],
    schema: T.StructType, block_bytes: int, corpus_bytes: int,
) -> DataFrame:
    """Candidates of :func:`nearest` with a corpus in cells.

    Queries ask their best cells first.  The k-th score found there is their floor: other cells get
    only the queries whose bound reaches it and return only what does, so neither the rows sent nor
    those returned grow with the number of cells that are out of reach.  Cells above ``block_bytes`` and queries
    above four times as much are cut by id hash.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = q.sparkSession
    arrow = to_arrow_schema(schema)
    wanted = min(MAX_PIVOTS, max(16, math.ceil(corpus_bytes / block_bytes)))
    sample = c.orderBy(F.xxhash64(id_col), id_col).limit(wanted).select(id_col, vec_col).toArrow()
    pivots = spark.sparkContext.broadcast(distinct_rows(_side(sample, id_col, vec_col, ()).matrix))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, distance = assign(_side(pa.Table.from_batches([batch]), id_col, vec_col, ()).matrix, pivots.value)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(distance)], [*batch.schema.names, "_cell", "_distance"])

    in_cells = T.StructType([*c.schema.fields, T.StructField("_cell", T.LongType()), T.StructField("_distance", T.DoubleType())])
    corpus = materialize(c.mapInArrow(placed, in_cells), "search-cells")
    beside = sum((F.coalesce(F.octet_length(F.col(x).cast("string")), F.lit(0)) for x in corpus_extra), F.lit(8))
    # One row for each cell: MAX_PIVOTS at most.
    found = corpus.groupBy("_cell").agg(F.max("_distance").alias("radius"), F.count(F.lit(1)).alias("n"), F.sum(beside + 8 * F.size(vec_col)).alias("bytes")).toPandas()
    radius, rows = np.zeros(len(pivots.value)), np.zeros(len(pivots.value), np.int64)
    radius[found["_cell"]], rows[found["_cell"]] = found["radius"], found["n"]
    cells = spark.sparkContext.broadcast(Cells(pivots.value, radius, rows))
    parts = {int(cell): math.ceil(size / block_bytes) for cell, size in zip(found["_cell"], found["bytes"], strict=True)}

    def routed(asked: DataFrame, first: bool) -> DataFrame:
        """A row for each cell a query needs."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                step = max(1, SCORE_CELLS // len(cells.value.rows))
                for at in range(0, batch.num_rows, step):
                    part = batch.slice(at, step)
                    matrix = _side(pa.Table.from_batches([part]), id_col, vec_col, ()).matrix
                    if first:
                        needed = cells.value.home(matrix, k)
                    else:
                        needed = cells.value.left_open(matrix, part.column("_floor").to_numpy(zero_copy_only=False), k)
                    ends = np.concatenate([[0], np.cumsum(needed.sum(1))]).astype(np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.nonzero(needed)[1].astype(np.int64)))
                    yield pa.RecordBatch.from_arrays([*part.columns, lists], [*part.schema.names, "_cells"])

        lists = T.StructType([*asked.schema.fields, T.StructField("_cells", T.ArrayType(T.LongType()))])
        return asked.mapInArrow(run, lists).withColumn("_cell", F.explode("_cells")).drop("_cells")

    def pair(left: pa.Table, right: pa.Table) -> pa.Table:
        held = _side(right, id_col, vec_col, corpus_extra)
        return pa.concat_tables([arrow.empty_table(), *_sliced(left, held, k, id_col, vec_col, query_extra, block_bytes, arrow)])

    def answered(asked: DataFrame) -> DataFrame:
        width = F.sum(8 * F.size(vec_col) + sum((F.coalesce(F.octet_length(F.col(x).cast("string")), F.lit(0)) for x in query_extra), F.lit(8)))
        sizes = {r["_cell"]: r["bytes"] for r in asked.groupBy("_cell").agg(width.alias("bytes")).collect()}
        layout = [(cell, parts[cell], math.ceil(size / (4 * block_bytes))) for cell, size in sizes.items()]
        layout_of = F.broadcast(spark.createDataFrame(layout, "_cell long, _parts long, _slices long"))
        every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
        own = lambda n: F.pmod(F.xxhash64(id_col), F.col(n))
        left = asked.join(layout_of, "_cell").withColumn("_slice", own("_slices")).withColumn("_part", every("_parts")).drop("_parts", "_slices")
        # Cells nobody asks stay where they are.
        right = corpus.drop("_distance").join(layout_of, "_cell").withColumn("_part", own("_parts")).withColumn("_slice", every("_slices")).drop("_parts", "_slices")
        keys = ["_cell", "_part", "_slice"]
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(pair, schema)

    order = [F.desc("score"), F.asc("neighbor_id")]
    home = materialize(routed(q.withColumn("_floor", F.lit(float("-inf"))), True), "search-home")
    near = materialize(top_k(answered(home), k, "query_id", order).select(schema.names), "search-near")
    floors = near.where(F.col("rank") == k).groupBy(F.col("query_id").alias(id_col)).agg(F.max("score").alias("_floor"))
    floored = q.join(floors, id_col, "left").withColumn("_floor", F.coalesce("_floor", F.lit(float("-inf"))))
    rest = materialize(routed(floored.select(*q.columns, "_floor"), False), "search-rest")
    return near.unionByName(answered(rest))


def top_k(df: DataFrame, k: int, key: str, order: Sequence[Column], rank_col: str = "rank") -> DataFrame:
    """First k rows per key; the literal bound lets each task drop the rest before the shuffle."""
    return df.withColumn(rank_col, F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(
        F.col(rank_col) <= k
    )


def hot_neighbors(neighbors: DataFrame, share: float = 0.001, least: int = 10_000) -> DataFrame:
    """Ids that are the neighbour of a large share of all queries; no more than ``1 / share``."""
    return hot_keys(neighbors.groupBy("neighbor_id").agg(F.count(F.lit(1)).alias("n")), "neighbor_id", "n", share, least)


def attach_payload(
    neighbors: DataFrame, corpus: DataFrame, columns: Sequence[str], id_col: str = "ticket_id", hot: DataFrame | None = None
) -> DataFrame:
    """Corpus columns of each neighbour, by key.

    With ``hot`` from :func:`hot_neighbors` the lists of such ids are dealt over several tasks, and only
    their corpus rows are copied.
    """
    payload = corpus.select(F.col(id_col).alias("neighbor_id"), *[F.col(c).alias(f"neighbor_{c}") for c in columns])
    if hot is None:
        return neighbors.join(payload, "neighbor_id")
    return salted_join(neighbors, payload, "neighbor_id", hot, F.col("query_id"), how="inner")


def retrieved_list(neighbors: DataFrame) -> DataFrame:
    """query_id with ``retrieved``: its neighbours' payload in rank order, scores clamped to [0, 1]."""
    item = F.struct(
        F.col("rank"),
        F.col("neighbor_subject").alias("subject"),
        F.col("neighbor_body").alias("body"),
        F.col("neighbor_answer").alias("answer"),
        F.col("neighbor_queue").alias("queue"),
        clamp01(F.col("score")).alias("score"),
    )
    return neighbors.groupBy("query_id").agg(F.array_sort(F.collect_list(item)).alias("retrieved"))


def majority_vote(
    queries: DataFrame, neighbors: DataFrame, k: int = DEFAULTS.top_k, id_col: str = "ticket_id", label_col: str = "neighbor_queue"
) -> DataFrame:
    """Label most of the k nearest carry; a tie goes to the label seen first, no neighbour to Unknown."""
    votes = (
        neighbors.where((F.col("rank") <= k) & F.col(label_col).isNotNull())
        .groupBy("query_id", label_col)
        .agg(F.count(F.lit(1)).alias("votes"), F.min("rank").alias("best_rank"))
        .groupBy("query_id")
        .agg(F.max_by(F.struct(label_col, "votes"), F.struct("votes", -F.col("best_rank"))).alias("w"))
        .select(F.col("query_id").alias(id_col), F.col(f"w.{label_col}").alias("_label"), F.col("w.votes").alias("_votes"))
    )
    return (
        queries.select(id_col)
        .join(votes, id_col, "left")
        .select(
            id_col,
            F.coalesce(F.col("_label").cast("string"), F.lit("Unknown")).alias("predicted_queue"),
            F.coalesce("_votes", F.lit(0)).alias("votes"),
        )
    )


def vote_grid(
    queries: DataFrame, neighbors: DataFrame, ks: Sequence[int], id_col: str = "ticket_id", label_col: str = "neighbor_queue"
) -> DataFrame:
    """Majority votes for several k from one neighbour table: id, k, predicted_queue."""
    sizes = F.array(*[F.lit(k) for k in ks])
    votes = (
        neighbors.where(F.col(label_col).isNotNull())
        .select("query_id", label_col, "rank", F.explode(F.filter(sizes, lambda k: k >= F.col("rank"))).alias("k"))
        .groupBy("query_id", "k", label_col)
        .agg(F.count(F.lit(1)).alias("votes"), F.min("rank").alias("best_rank"))
        .groupBy("query_id", "k")
        .agg(F.max_by(label_col, F.struct("votes", -F.col("best_rank"))).alias("_label"))
        .withColumnRenamed("query_id", id_col)
    )
    asked = queries.select(id_col, F.explode(sizes).alias("k"))
    return asked.join(votes, [id_col, "k"], "left").select(
        id_col, "k", F.coalesce(F.col("_label").cast("string"), F.lit("Unknown")).alias("predicted_queue")
    )


def top1_label(queries: DataFrame, neighbors: DataFrame, id_col: str = "ticket_id", label_col: str = "neighbor_queue") -> DataFrame:
    first = neighbors.where(F.col("rank") == 1).select(F.col("query_id").alias(id_col), F.col(label_col).alias("_label"))
    return queries.select(id_col).join(first, id_col, "left").select(
        id_col, F.coalesce(F.col("_label").cast("string"), F.lit("Unknown")).alias("predicted_queue")
    )


def rerank(candidates: DataFrame, scorer: Column, keep: int = DEFAULTS.rerank_keep, key: str = "query_id") -> DataFrame:
    """Reorder candidates by a second score and keep the best; first-pass rank decides ties."""
    return top_k(
        candidates.withColumn("rerank_score", scorer),
        keep,
        key,
        [F.desc("rerank_score"), F.asc("rank")],
        "rerank_position",
    )


def token_overlap(a: Column, b: Column) -> Column:
    """Jaccard similarity of two token arrays; 0 when both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(F.lit(0.0))

