"""Label, length, word and tag distributions; splits and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from ticketloom.functions import text as X
from ticketloom.operators import corpus as C
from ticketloom.operators import profile as P
from ticketloom.operators import split as S
from ticketloom.plans import fragments as Q
from ticketloom.plans.corpus_queries import _LEMMAS, cleaned, lemmatized
from ticketloom.plans.registry import query
from ticketloom.plans.retrieval_queries import split_vectors
from ticketloom.sources import tables as IO
from ticketloom.sources import views

_COUNTS = "n AS (SELECT queue, count(*) AS n FROM v_tickets WHERE queue IS NOT NULL GROUP BY queue)"


@query("queue_distribution", f"WITH {Q.TICKETS}, {_COUNTS} SELECT queue AS value, n FROM n")
def queue_distribution(spark, sf):
    return P.value_counts(views.tickets(spark, sf), "queue")


@query(
    "priority_type_distribution",
    f"""WITH {Q.ATTRIBUTES} SELECT 'priority' AS field, priority AS value, count(*) AS n FROM v_attr WHERE priority IS NOT NULL GROUP BY priority
UNION ALL SELECT 'type', type, count(*) FROM v_attr WHERE type IS NOT NULL GROUP BY type""",
)
def priority_type_distribution(spark, sf):
    return P.several_value_counts(views.attributes(spark, sf), ["priority", "type"])


@query(
    "class_imbalance",
    f"""WITH {Q.TAGGED}, n AS (SELECT queue, count(*) AS n FROM v_tags WHERE queue IS NOT NULL GROUP BY queue),
p AS (SELECT n, n / sum(n) OVER () AS p FROM n)
SELECT count(*) AS classes, CAST(sum(n) AS BIGINT) AS total, round(max(n) / min(n), 4) AS imbalance_ratio, round(-sum(p * ln(p)), 6) AS entropy_nats,
  round(-sum(p * log2(p)), 6) AS entropy_bits, round(-sum(p * ln(p)) / ln(count(*)), 6) AS balance,
  CASE WHEN max(n) / min(n) > 10 THEN 'severe' WHEN max(n) / min(n) > 3 THEN 'moderate' ELSE 'mild' END AS severity FROM p""",
)
def class_imbalance(spark, sf):
    return P.class_imbalance(views.tagged(spark, sf))


@query("class_weights", f"WITH {Q.TAGGED}, n AS (SELECT queue, count(*) AS n FROM v_tags GROUP BY queue) SELECT queue, n, sum(n) OVER () / (count(*) OVER () * n) AS class_weight FROM n")
def class_weights(spark, sf):
    return P.class_weights(views.tagged(spark, sf))


@query(
    "length_describe",
    f"""WITH {Q.ANSWERED}, t AS (SELECT 'body_length' AS field, length(body) AS v FROM v_pairs UNION ALL SELECT 'answer_length', length(answer) FROM v_pairs)
SELECT field, count(*) AS count, round(avg(v), 1) AS mean, round(stddev_samp(v), 1) AS std, CAST(min(v) AS DOUBLE) AS min, round(quantile_cont(v, 0.25), 1) AS p25,
  round(quantile_cont(v, 0.5), 1) AS p50, round(quantile_cont(v, 0.75), 1) AS p75, CAST(max(v) AS DOUBLE) AS max FROM t WHERE v IS NOT NULL GROUP BY field""",
)
def length_describe(spark, sf):
    return P.describe(C.add_length_columns(views.answered(spark, sf)), ["body_length", "answer_length"])


@query(
    "length_histogram",
    f"""WITH {Q.TICKETS}, v AS (SELECT least(length(body), 2000) AS v FROM v_tickets WHERE body IS NOT NULL), r AS (SELECT min(v) AS lo, max(v) AS hi FROM v),
w AS (SELECT lo, CASE WHEN hi > lo THEN (hi - lo) / 60 ELSE 1.0 / 60 END AS w FROM r),
b AS (SELECT CAST(least(floor((v - lo) / w), 59) AS INTEGER) AS bin, count(*) AS n FROM v, w GROUP BY 1),
g AS (SELECT CAST(unnest(range(60)) AS INTEGER) AS bin)
SELECT g.bin, round(lo + g.bin * w, 6) AS lo, round(lo + (g.bin + 1) * w, 6) AS hi, coalesce(n, 0) AS n FROM w, g LEFT JOIN b ON b.bin = g.bin""",
)
def length_histogram(spark, sf):
    return P.histogram(C.add_length_columns(views.tickets(spark, sf)), "body_length", clip=2000)


def _token_counts(spark, sf):
    return cleaned(spark, sf).select(X.token_count(F.col("clean_body")).alias("tokens"))


@query(
    "token_describe",
    f"""WITH {Q.CLEANED}, t AS (SELECT len(string_split(clean_body, ' ')) + 2 AS v FROM v_clean)
SELECT 'tokens' AS field, count(*) AS count, round(avg(v), 1) AS mean, round(stddev_samp(v), 1) AS std, CAST(min(v) AS DOUBLE) AS min, round(quantile_cont(v, 0.25), 1) AS p25,
  round(quantile_cont(v, 0.5), 1) AS p50, round(quantile_cont(v, 0.75), 1) AS p75, CAST(max(v) AS DOUBLE) AS max FROM t""",
)
def token_describe(spark, sf):
    return P.describe(_token_counts(spark, sf), ["tokens"])


def _top_words_sql(n, extra=""):
    return f"""WITH {_LEMMAS}, w AS (SELECT queue, unnest(string_split(lemmatized_body, ' ')) AS word FROM lemmatized),
c AS (SELECT queue, word, count(*) AS n FROM w WHERE word <> '' {extra} GROUP BY 1, 2)
SELECT queue, CAST(place AS INTEGER) AS place, word, n FROM (SELECT *, row_number() OVER (PARTITION BY queue ORDER BY n DESC, word) AS place FROM c) t WHERE place <= {n}"""


@query("top_keywords_per_queue", _top_words_sql(10))
def top_keywords_per_queue(spark, sf):
    return P.top_words(lemmatized(spark, sf), 10)


@query("top_domain_keywords", _top_words_sql(5, f"AND length(word) > 2 AND word NOT IN ({Q.STOP_LIST})"))
def top_domain_keywords(spark, sf):
    return P.top_words(lemmatized(spark, sf), 5, stop_words=X.DOMAIN_STOP_WORDS, min_chars=3)


_TAGS = f"""{Q.TAGGED}, tags AS (SELECT tag, count(*) AS n FROM (SELECT tag_1 AS tag FROM v_tags UNION ALL SELECT tag_2 FROM v_tags UNION ALL SELECT tag_3 FROM v_tags) t WHERE tag IS NOT NULL GROUP BY tag)"""


@query("tag_frequency", f"WITH {_TAGS} SELECT tag, n FROM tags ORDER BY n DESC, tag LIMIT 20")
def tag_frequency(spark, sf):
    return P.tag_frequency(views.tagged(spark, sf))


@query("unique_tags", f"WITH {_TAGS} SELECT count(*) AS unique_tags FROM tags")
def unique_tags(spark, sf):
    return P.unique_tags(views.tagged(spark, sf))


@query(
    "queue_tag_crosstab",
    f"""WITH {_TAGS}, lead AS (SELECT tag FROM tags ORDER BY n DESC, tag LIMIT 10),
b AS (SELECT queue, CASE WHEN tag_1 IN (SELECT tag FROM lead) THEN tag_1 ELSE 'other' END AS bucket FROM v_tags WHERE queue IS NOT NULL),
g AS (SELECT q.queue, k.bucket FROM (SELECT DISTINCT queue FROM b) q, (SELECT DISTINCT bucket FROM b) k)
SELECT g.queue, g.bucket, count(b.queue) AS n FROM g LEFT JOIN b ON b.queue = g.queue AND b.bucket = g.bucket GROUP BY 1, 2""",
)
def queue_tag_crosstab(spark, sf):
    return P.tag_crosstab(views.tagged(spark, sf))


@query("stratified_split", f"WITH {Q.TICKETS}, {Q.split('v_tickets')} SELECT ticket_id, queue, split FROM parts")
def stratified_split(spark, sf):
    return S.stratified_split(views.tickets(spark, sf)).select("ticket_id", "queue", "split")


@query("split_sizes", f"WITH {Q.TAGGED}, {Q.split('v_tags')} SELECT queue, count(*) AS n, count(*) FILTER (split = 'train') AS n_train, count(*) FILTER (split = 'val') AS n_val, count(*) FILTER (split = 'test') AS n_test FROM parts GROUP BY queue")
def split_sizes(spark, sf):
    return S.split_sizes(views.tagged(spark, sf))


_SHARES = "SELECT queue, split, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY split), 3) AS share FROM parts WHERE queue IS NOT NULL GROUP BY queue, split"


@query("split_proportions", f"WITH {Q.TICKETS}, {Q.split('v_tickets')} {_SHARES}")
def split_proportions(spark, sf):
    return S.split_proportions(S.stratified_split(views.tickets(spark, sf)))


@query(
    "split_comparison",
    f"""WITH {Q.TAGGED}, {Q.split('v_tags')}, s AS ({_SHARES})
SELECT queue, max(share) FILTER (split = 'train') AS train, max(share) FILTER (split = 'val') AS val, max(share) FILTER (split = 'test') AS test FROM s GROUP BY queue""",
)
def split_comparison(spark, sf):
    return S.split_comparison(S.stratified_split(views.tagged(spark, sf)))


@query("eval_sample", f"""WITH {Q.TICKETS}, c AS (SELECT queue, count(*) AS n FROM v_tickets WHERE queue IS NOT NULL GROUP BY queue),
e AS (SELECT queue, least(250, sum(n) OVER ()) AS quota, CAST(least(250, sum(n) OVER ()) * n AS DOUBLE) / sum(n) OVER () AS exact FROM c),
b AS (SELECT *, floor(exact) AS base, row_number() OVER (ORDER BY round(exact - floor(exact), 9) DESC, queue) AS place FROM e),
k AS (SELECT queue, base + CASE WHEN place <= quota - sum(base) OVER () THEN 1 ELSE 0 END AS take FROM b),
r AS (SELECT *, row_number() OVER (PARTITION BY queue ORDER BY md5(concat_ws(':', CAST(ticket_id AS VARCHAR), '42')), ticket_id) AS rn FROM v_tickets WHERE queue IS NOT NULL)
SELECT r.ticket_id, r.queue FROM r JOIN k ON k.queue = r.queue WHERE rn <= take""")
def eval_sample(spark, sf):
    return S.stratified_sample(views.tickets(spark, sf)).select("ticket_id", "queue")


@query(
    "seeded_sample",
    f"WITH {Q.TICKETS} SELECT ticket_id, language FROM v_tickets ORDER BY md5(concat_ws(':', CAST(ticket_id AS VARCHAR), '42')), ticket_id LIMIT 200",
)
def seeded_sample(spark, sf):
    return S.seeded_sample(views.tickets(spark, sf).select("ticket_id", "language"), 200)


@query("fixed_folds", f"WITH {Q.VECTORS}, {Q.split('v_vec')} SELECT ticket_id, queue, CASE WHEN split = 'train' THEN -1 ELSE 0 END AS fold FROM parts WHERE split IN ('train', 'val')")
def fixed_folds(spark, sf):
    return S.fixed_folds(split_vectors(spark, sf)).select("ticket_id", "queue", "fold")


@query(
    "vector_split_check",
    f"""WITH {Q.VECTORS}, {Q.split('v_vec')} SELECT split, count(*) AS n, count(embedding) AS vectors, count(DISTINCT ticket_id) AS tickets, count(DISTINCT queue) AS labels FROM parts GROUP BY split""",
)
def vector_split_check(spark, sf):
    return split_vectors(spark, sf).groupBy("split").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("embedding").alias("vectors"),
        F.countDistinct("ticket_id").alias("tickets"),
        F.countDistinct("queue").alias("labels"),
    )


@query("split_alignment", f"SELECT count(*) AS left_rows, count(*) AS right_rows, 0 AS only_left, 0 AS only_right FROM embeddings")
def split_alignment(spark, sf):
    """Vectors follow their rows: the split table and the source hold the same keys."""
    return IO.alignment_report(split_vectors(spark, sf), views.vectors(spark, sf), "ticket_id")
