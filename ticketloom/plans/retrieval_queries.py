"""Similarity search, votes and their metrics over the stratified split of the vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.operators import metrics as M
from ticketloom.operators import retrieval as R
from ticketloom.operators import split as S
from ticketloom.plans import fragments as Q
from ticketloom.plans.registry import query
from ticketloom.settings import DEFAULTS
from ticketloom.sources import views


def split_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return S.stratified_split(views.vectors(spark, sf))


def searched(spark: SparkSession, sf: str, k: int = 10, queries: str = "test") -> tuple[DataFrame, DataFrame]:
    parts = split_vectors(spark, sf)
    asked = parts.where(F.col("split") == queries)
    return asked, R.nearest(asked, parts.where(F.col("split") == "train"), k)


def voted(spark: SparkSession, sf: str, k: int = DEFAULTS.top_k, queries: str = "test") -> DataFrame:
    """ticket_id, queue, predicted_queue, votes."""
    asked, found = searched(spark, sf, k, queries)
    return R.majority_vote(asked, found, k).join(asked.select("ticket_id", "queue"), "ticket_id")


@query("knn_topk", f"WITH {Q.VECTOR_NEIGHBORS} SELECT query_id, CAST(rank AS INTEGER) AS rank, neighbor_id, neighbor_queue, round(score, 6) AS score FROM nn")
def knn_topk(spark, sf):
    return searched(spark, sf)[1].withColumn("score", F.round("score", 6))


@query("knn_vote", f"WITH {Q.VECTOR_VOTES} SELECT ticket_id, queue, predicted_queue, votes FROM votes")
def knn_vote(spark, sf):
    return voted(spark, sf)


@query("knn_top1", f"WITH {Q.VECTOR_NEIGHBORS}, {Q.vote('parts', 1)} SELECT ticket_id, predicted_queue FROM votes")
def knn_top1(spark, sf):
    asked, found = searched(spark, sf, 1)
    return R.top1_label(asked, found)


@query("knn_vote_eval", f"WITH {Q.VECTOR_VOTES}, {Q.class_counts('votes')} SELECT {Q.WEIGHTED} FROM cc_f")
def knn_vote_eval(spark, sf):
    return M.weighted_scores(voted(spark, sf))


_MATCHES = f"""{Q.VECTOR_NEIGHBORS},
m AS (SELECT p.ticket_id, p.queue, min(n.rank) FILTER (n.neighbor_queue = p.queue) AS match_rank, max(n.score) FILTER (n.rank = 1) AS top_score
  FROM parts p LEFT JOIN nn n ON n.query_id = p.ticket_id WHERE p.split = 'test' GROUP BY 1, 2)"""


def matched(spark: SparkSession, sf: str) -> DataFrame:
    return M.first_match(*searched(spark, sf))


@query(
    "retrieval_at_k",
    f"WITH {_MATCHES} SELECT CAST(k AS INTEGER) AS k, round(avg(CASE WHEN match_rank <= k THEN 1 ELSE 0 END), 4) AS hit_rate FROM m, (SELECT unnest([1, 3, 5, 10]) AS k) g GROUP BY k",
)
def retrieval_at_k(spark, sf):
    return M.retrieval_at_k(matched(spark, sf))


@query("mrr_at_10", f"WITH {_MATCHES} SELECT round(avg(coalesce(1 / match_rank, 0)), 4) AS mrr FROM m")
def mrr_at_10(spark, sf):
    return M.mean_reciprocal_rank(matched(spark, sf))


@query("mean_top1", f"WITH {_MATCHES} SELECT round(avg(top_score), 4) AS mean_top1 FROM m")
def mean_top1(spark, sf):
    return M.mean_top1(matched(spark, sf))


@query(
    "retrieval_per_class",
    f"WITH {_MATCHES} SELECT queue, round(avg(CASE WHEN match_rank <= 5 THEN 1 ELSE 0 END), 4) AS hit_rate, count(*) AS queries FROM m GROUP BY queue",
)
def retrieval_per_class(spark, sf):
    return M.retrieval_per_class(matched(spark, sf))


@query(
    "confusion_matrix",
    f"""WITH {Q.VECTOR_VOTES}, l AS (SELECT queue AS label FROM votes UNION SELECT predicted_queue FROM votes)
SELECT a.label AS truth, b.label AS predicted, count(v.ticket_id) AS n FROM l a CROSS JOIN l b LEFT JOIN votes v ON v.queue = a.label AND v.predicted_queue = b.label GROUP BY 1, 2""",
)
def confusion_matrix(spark, sf):
    return M.confusion_matrix(voted(spark, sf))


@query(
    "classification_report",
    f"""WITH {Q.VECTOR_VOTES}, {Q.class_counts('votes')}
SELECT label, round("precision", 4) AS "precision", round(recall, 4) AS recall, round(f1, 4) AS f1, support FROM cc_f
UNION ALL SELECT 'accuracy', round(sum(tp) / sum(support), 4), round(sum(tp) / sum(support), 4), round(sum(tp) / sum(support), 4), CAST(sum(support) AS BIGINT) FROM cc_f
UNION ALL SELECT 'macro avg', round(avg("precision"), 4), round(avg(recall), 4), round(avg(f1), 4), CAST(sum(support) AS BIGINT) FROM cc_f
UNION ALL SELECT 'weighted avg', round(sum(support * "precision") / sum(support), 4), round(sum(support * recall) / sum(support), 4), round(sum(support * f1) / sum(support), 4), CAST(sum(support) AS BIGINT) FROM cc_f""",
)
def classification_report(spark, sf):
    return M.classification_report(voted(spark, sf))


VOTE_SIZES = [1, 3, 5, 10]


def _grid_sql(queries: str) -> str:
    """CTEs ending in ``scores``: k and the four metrics."""
    nn = Q.VECTORS + ",\n" + Q.split("v_vec") + ",\n" + Q.neighbors("parts", 10, queries)
    parts = ",\n".join(Q.vote("parts", k, queries=queries, out=f"v{k}") for k in VOTE_SIZES)
    union = " UNION ALL ".join(f"SELECT {k} AS k, queue, predicted_queue FROM v{k}" for k in VOTE_SIZES)
    return f"{nn},\n{parts},\ngrid AS ({union}),\n{Q.class_counts('grid', by='k')},\nscores AS (SELECT k, {Q.WEIGHTED} FROM cc_f GROUP BY k)"


def vote_scores(spark: SparkSession, sf: str, queries: str) -> DataFrame:
    """k, accuracy, precision, recall, f1 of the label vote for each neighbourhood size."""
    asked, found = searched(spark, sf, max(VOTE_SIZES), queries)
    grid = R.vote_grid(asked, found, VOTE_SIZES).join(asked.select("ticket_id", "queue"), "ticket_id")
    return M.weighted_scores(grid, by=["k"])


@query("weighted_scores", f"""WITH {_grid_sql('test')} SELECT CAST(k AS INTEGER) AS k, accuracy, "precision", recall, f1 FROM scores""")
def weighted_scores(spark, sf):
    return vote_scores(spark, sf, "test")


@query(
    "grid_best",
    f"""WITH {_grid_sql('val')} SELECT 'vote' AS family, CAST(k AS INTEGER) AS k, f1 AS val_f1 FROM (
  SELECT *, row_number() OVER (ORDER BY f1 DESC, k) AS rn FROM scores) t WHERE rn = 1""",
)
def grid_best(spark, sf):
    scored = vote_scores(spark, sf, "val").select(
        F.lit("vote").alias("family"), "k", F.col("k").alias("grid_pos"), F.col("f1").alias("val_f1")
    )
    return M.best_candidate(scored).drop("grid_pos")


@query(
    "model_ranking",
    f"""WITH {_grid_sql('test')}
SELECT 'vote@' || k AS model, accuracy, "precision", recall, f1, CAST(row_number() OVER (ORDER BY f1 DESC, 'vote@' || k) AS INTEGER) AS place,
  row_number() OVER (ORDER BY f1 DESC, 'vote@' || k) = 1 AS recommended FROM scores""",
)
def model_ranking(spark, sf):
    scored = vote_scores(spark, sf, "test").withColumn("model", F.concat(F.lit("vote@"), F.col("k").cast("string"))).drop("k")
    return M.rank_models(scored)


_LONG = " UNION ALL ".join(f"""SELECT '{m}' AS metric, k, "{m}" AS value FROM scores""" for m in ["accuracy", "precision", "recall", "f1"])


@query(
    "metric_delta",
    f"""WITH {_grid_sql('test')}, l AS ({_LONG}) SELECT a.metric, a.value AS base, b.value AS other, round(b.value - a.value, 4) AS delta,
  CASE WHEN a.value <> 0 THEN round(100 * (b.value - a.value) / a.value, 1) END AS delta_pct FROM l a JOIN l b ON a.metric = b.metric AND a.k = 1 AND b.k = 5""",
)
def metric_delta(spark, sf):
    scored = vote_scores(spark, sf, "test")
    single, vote = (M.metric_rows(scored.where(F.col("k") == k)) for k in (1, 5))
    return M.metric_delta(single, vote)


@query(
    "metric_log",
    f"""WITH {_grid_sql('test')}, l AS ({_LONG}) SELECT 'vote@' || k AS run, 'metric' AS kind, metric AS key, printf('%.4f', value) AS value FROM l
UNION ALL SELECT 'vote@' || k, 'param', 'top_k', CAST(k AS VARCHAR) FROM scores""",
)
def metric_log(spark, sf):
    scored = vote_scores(spark, sf, "test").withColumn("run", F.concat(F.lit("vote@"), F.col("k").cast("string")))
    return M.run_log(scored, "run", params={"top_k": F.col("k").cast("string")})
