import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ticketloom.functions import vectors as V
from ticketloom.operators import cells as C
from ticketloom.operators import metrics as M
from ticketloom.operators import retrieval as R


def unit_rows(spark, n, dim, seed, first_id=0, copies=False):
    rng = np.random.default_rng(seed)
    m = rng.normal(size=(n, dim)).astype(np.float32)
    if copies:
        m[: n // 3] = m[0]  # a third of the rows are one vector
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    rows = [(first_id + i, [float(x) for x in m[i]], f"q{i % 4}") for i in range(n)]
    return spark.createDataFrame(rows, "ticket_id long, embedding array<float>, queue string"), m


def brute(qm, cm, k, q0, c0):
    scores = np.round(qm.astype(np.float64) @ cm.astype(np.float64).T, 9)
    out = set()
    for i, row in enumerate(scores):
        order = sorted(range(len(row)), key=lambda j: (-row[j], j))[:k]
        out |= {(q0 + i, r + 1, c0 + j) for r, j in enumerate(order)}
    return out


@pytest.mark.parametrize(
    "ways",
    [{}, {"broadcast_bytes": 60 * 8 * 8}, {"broadcast_bytes": 0, "block_bytes": 600}],
    ids=["corpus broadcast", "queries broadcast", "cells"],
)
def test_every_way_is_exact(spark, ways):
    queries, qm = unit_rows(spark, 60, 8, 1, 10_000)
    corpus, cm = unit_rows(spark, 400, 8, 2, copies=True)
    got = R.nearest(queries, corpus.repartition(6), 7, **ways)
    assert {(r["query_id"], r["rank"], r["neighbor_id"]) for r in got.collect()} == brute(qm, cm, 7, 10_000, 0)
    assert {r["neighbor_queue"] for r in got.collect()} <= {"q0", "q1", "q2", "q3"}


def test_many_queries_against_many_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        queries, qm = unit_rows(spark, 90, 4, 3)
        corpus, cm = unit_rows(spark, 300, 4, 4)
        got = R.nearest(queries, corpus, 5, broadcast_bytes=90 * 4 * 8)
        assert {(r["query_id"], r["rank"], r["neighbor_id"]) for r in got.collect()} == brute(qm, cm, 5, 0, 0)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_small_and_empty_corpus(spark):
    queries, _ = unit_rows(spark, 3, 4, 5)
    corpus, _ = unit_rows(spark, 2, 4, 6, 100)
    assert R.nearest(queries, corpus, 5).count() == 6
    none = R.nearest(queries, corpus.where("false"), 5)
    assert none.count() == 0
    assert {r[1] for r in R.majority_vote(queries, none).collect()} == {"Unknown"}
    matches = M.first_match(queries, none)
    assert {r["hit_rate"] for r in M.retrieval_at_k(matches).collect()} == {0.0}


def test_vote_tie_goes_to_the_nearest(spark):
    queries = spark.createDataFrame([(1,)], "ticket_id long")
    rows = [(1, 1, "b"), (1, 2, "a"), (1, 3, "a"), (1, 4, "b"), (1, 5, "c")]
    found = spark.createDataFrame(rows, "query_id long, rank int, neighbor_queue string")
    assert tuple(R.majority_vote(queries, found).first()) == (1, "b", 2)
    grid = {r["k"]: r["predicted_queue"] for r in R.vote_grid(queries, found, [1, 3, 5]).collect()}
    assert grid == {1: "b", 3: "a", 5: "b"}


def test_retrieval_metrics(spark):
    queries = spark.createDataFrame([(i, "a") for i in range(4)], "ticket_id long, queue string")
    hits = {0: 1, 1: 3, 2: 10}
    rows = [(q, r, "a" if hits.get(q) == r else "z", 0.5) for q in range(4) for r in range(1, 11)]
    found = spark.createDataFrame(rows, "query_id long, rank int, neighbor_queue string, score double")
    matches = M.first_match(queries, found)
    at = {r["k"]: r["hit_rate"] for r in M.retrieval_at_k(matches).collect()}
    assert at == {1: 0.25, 3: 0.5, 5: 0.5, 10: 0.75}
    assert M.mean_reciprocal_rank(matches).first()[0] == round((1 + 1 / 3 + 1 / 10) / 4, 4)
    assert M.mean_top1(matches).first()[0] == 0.5


def test_rerank_keeps_best_by_second_score(spark):
    rows = [(1, 1, 0.1), (1, 2, 0.9), (1, 3, 0.9)]
    got = R.rerank(spark.createDataFrame(rows, "query_id long, rank int, s double"), F.col("s"), 2)
    assert [(r["rank"], r["rerank_position"]) for r in got.orderBy("rerank_position").collect()] == [(2, 1), (3, 2)]


def test_vector_expressions(spark):
    df = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0])], "a array<float>, z array<float>")
    row = df.select(
        V.l2_normalize(F.col("a")), V.l2_normalize(F.col("z")), V.l2_from_inner(F.lit(0.5)), V.clamp01(F.lit(1.2)), V.clamp01(F.lit(-0.1))
    ).first()
    assert row[0] == [0.6, 0.8] and row[1] == [0.0, 0.0] and row[2] == 1.0 and row[3] == 1.0 and row[4] == 0.0


def test_no_pair_ever_becomes_a_row(spark, sf):
    from ticketloom.plans import catalog

    for name in ("knn_topk", "knn_vote_eval", "triage_records"):
        plan = catalog.queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


WAYS = [{}, {"broadcast_bytes": 400}, {"broadcast_bytes": 0, "block_bytes": 64}]


@pytest.mark.parametrize("way", WAYS)
def test_vectors_with_holes_take_no_part(spark, way):
    nan = float("nan")
    corpus = [(i, [float(i), 1.0]) for i in range(12)] + [(20, [nan, 1.0]), (21, [None, 1.0]), (22, [float("inf"), 0.0]), (23, None)]
    df = spark.createDataFrame(corpus, "ticket_id long, embedding array<double>")
    asked = spark.createDataFrame([(1, [1.0, 0.0]), (2, [nan, 0.0])], "ticket_id long, embedding array<double>")
    found = R.nearest(asked, df, 5, corpus_extra=(), **way).collect()
    assert sorted((r["query_id"], r["rank"], r["neighbor_id"]) for r in found) == [(1, r + 1, 11 - r) for r in range(5)]


@pytest.mark.parametrize("way", WAYS)
def test_vectors_of_different_lengths_are_an_error(spark, way):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0]), (3, [1.0, 2.0, 3.0])], "ticket_id long, embedding array<double>").coalesce(1)
    asked = spark.createDataFrame([(9, [1.0, 0.0])], "ticket_id long, embedding array<double>")
    with pytest.raises(Exception, match="differ in length|mismatch"):
        R.nearest(asked, df, 2, corpus_extra=(), **way).collect()


def _clustered(n, dim, centres, seed):
    rng = np.random.default_rng(seed)
    middle = np.random.default_rng(99).normal(size=(centres, dim))
    return middle[rng.integers(0, centres, n)] + rng.normal(0, 0.02, (n, dim))


def _in_cells(corpus, n):
    pivots = C.distinct_rows(corpus[:n])
    cell, distance = C.assign(corpus, pivots)
    radius = np.zeros(len(pivots))
    np.maximum.at(radius, cell, distance)
    return C.Cells(pivots, radius, np.bincount(cell, minlength=len(pivots))), cell


def test_no_score_exceeds_the_bound_of_its_cell():
    for corpus in (_clustered(500, 6, 9, 1), np.repeat(_clustered(5, 6, 5, 2), 40, axis=0), 1e6 * _clustered(300, 6, 4, 3)):
        cells, cell = _in_cells(corpus, 25)
        queries = np.vstack([_clustered(40, 6, 9, 4), np.zeros((1, 6)), corpus[:5]])
        assert (np.round(queries @ corpus.T, 9) <= cells.bounds(queries)[:, cell]).all()


def test_what_is_sent_does_not_grow_with_the_cells():
    corpus, queries, k = _clustered(6000, 12, 40, 5), _clustered(50, 12, 40, 6), 5
    sent, rows = [], []
    for n in (100, 200, 400, 800):
        cells, cell = _in_cells(corpus, n)
        scores = np.round(queries @ corpus.T, 9)
        home = cells.home(queries, k)
        assert (cells.rows @ home.T >= k).all()
        floors = np.sort(np.where(home[:, cell], scores, -np.inf), axis=1)[:, -k]
        left = cells.left_open(queries, floors, k)
        best = np.sort(scores, axis=1)[:, -k:]
        asked = home | left
        assert (np.sort(np.where(asked[:, cell], scores, -np.inf), axis=1)[:, -k:] == best).all()
        sent.append((asked * cells.rows).sum() / scores.size)
        rows.append((left[:, cell] & (scores >= floors[:, None])).sum())
    assert max(sent) < 0.25 and sent[-1] <= sent[0] and max(rows) <= 60 * len(queries)


@pytest.mark.parametrize("block_bytes", [400, 3000, 1 << 20])
def test_cells_of_any_size_are_exact(spark, block_bytes):
    cm, qm = _clustered(700, 6, 12, 7), _clustered(80, 6, 12, 8)
    cm[:250] = cm[0]  # one cell holds a third of the rows
    qm[:30] = cm[0]  # and many queries
    frame = lambda m, at: spark.createDataFrame([(at + i, v.tolist(), f"q{i % 3}") for i, v in enumerate(m)], "ticket_id long, embedding array<double>, queue string")
    got = R.nearest(frame(qm, 10_000), frame(cm, 0).repartition(5), 7, query_extra=("queue",), broadcast_bytes=0, block_bytes=block_bytes).collect()
    assert {(r["query_id"], r["rank"], r["neighbor_id"]) for r in got} == brute(qm, cm, 7, 10_000, 0) and len(got) == 560
    assert all(r["neighbor_queue"] == f"q{r['neighbor_id'] % 3}" and r["queue"] == f"q{(r['query_id'] - 10_000) % 3}" for r in got)
    few = R.nearest(frame(qm, 10_000), frame(cm[248:253], 0), 7, broadcast_bytes=0, block_bytes=block_bytes)
    assert few.count() == 5 * 80


def test_a_neighbour_of_all_is_dealt_over_tasks(spark):
    found = spark.range(3000).selectExpr("id AS query_id", "1 AS rank", "IF(id % 10 = 0, id % 7, 99) AS neighbor_id", "0.5D AS score")
    corpus = spark.range(100).selectExpr("id AS ticket_id", "concat('b', id) AS body")
    hot = R.hot_neighbors(found, share=0.2, least=100)
    assert [r[0] for r in hot.collect()] == [99]
    plain, dealt = R.attach_payload(found, corpus, ["body"]), R.attach_payload(found, corpus, ["body"], hot=hot)
    assert sorted(map(tuple, plain.select(sorted(plain.columns)).collect())) == sorted(map(tuple, dealt.select(sorted(plain.columns)).collect()))
    held = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {c: spark.conf.get(c) for c in held}
    try:
        for c, v in held.items():
            spark.conf.set(c, v)
        tasks = dealt.where("neighbor_id = 99").groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    assert len(tasks) > 2 and max(t["count"] for t in tasks) < 2000


def test_a_groups_queries_become_a_matrix_in_slices():
    """Queries may take four blocks; as doubles they never take more than a part of one."""
    table = lambda ids, m: pa.table({"ticket_id": ids, "embedding": pa.array(list(m), pa.list_(pa.float32())), "_floor": np.full(len(ids), -np.inf)})
    rng = np.random.default_rng(5)
    asked, held = (rng.standard_normal((n, 8)).astype(np.float32) for n in (100, 30))
    arrow = pa.schema([("query_id", pa.int64()), ("rank", pa.int32()), ("neighbor_id", pa.int64()), ("score", pa.float64())])
    side = R._side(table(range(30), held), "ticket_id", "embedding", ())
    found = list(R._sliced(table(range(100), asked), side, 3, "ticket_id", "embedding", (), 5120, arrow))
    assert [t.num_rows for t in found] == [30] * 10
    got = pa.concat_tables(found).sort_by([("query_id", "ascending"), ("rank", "ascending")]).column("neighbor_id").to_numpy().reshape(100, 3)
    assert (got == np.argsort(-(asked.astype(float) @ held.astype(float).T), axis=1)[:, :3]).all()
