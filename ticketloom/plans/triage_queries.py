"""Triage records, prompts, reply parsing and text overlap over the answered cases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.functions import replies as J
from ticketloom.operators import features as E
from ticketloom.operators import metrics as M
from ticketloom.operators import overlap as O
from ticketloom.operators import retrieval as R
from ticketloom.operators import split as S
from ticketloom.operators import triage as T
from ticketloom.plans import fragments as Q
from ticketloom.plans.registry import query
from ticketloom.plans.stem_sql import stems
from ticketloom.settings import JobSettings
from ticketloom.sources import views

CASE_SETTINGS = JobSettings(confidence_threshold=Q.CASE_THRESHOLD)


def split_cases(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Encoded test and train cases, from one written table: search, payload and prompt all read it."""
    parts, facts = E.store_vectors(T.encode_tickets(S.stratified_split(views.cases(spark, sf))), "cases")
    facts.require_unit()
    facts.require_complete()
    return parts.where(F.col("split") == "test").drop("split"), parts.where(F.col("split") == "train")


def records(spark: SparkSession, sf: str, rerank: bool = False) -> DataFrame:
    asked, corpus = split_cases(spark, sf)
    return T.triage(asked, corpus, M.label_list(views.cases(spark, sf)), CASE_SETTINGS, rerank=rerank)


RECORDS_SQL = f"""{Q.CASE_NEIGHBORS},
best AS (SELECT p.ticket_id, p.subject, p.body, p.queue, p.answer, greatest(0.0, least(coalesce(n.score, 0.0), 1.0)) AS confidence_score, coalesce(c.queue, 'Unknown') AS nearest_queue, c.answer AS nearest_answer
  FROM parts p LEFT JOIN nn n ON n.query_id = p.ticket_id AND n.rank = 1 LEFT JOIN v_cases c ON c.ticket_id = n.neighbor_id WHERE p.split = 'test'),
rec AS (SELECT *, confidence_score < {Q.CASE_THRESHOLD} AS needs_human_review, nearest_queue AS predicted_queue,
  CASE WHEN confidence_score >= {Q.CASE_THRESHOLD} THEN nearest_answer END AS generated_answer FROM best)"""


@query(
    "triage_records",
    f"""WITH {RECORDS_SQL} SELECT ticket_id, predicted_queue, generated_answer, needs_human_review, round(confidence_score, 6) AS confidence_score,
  CASE WHEN needs_human_review THEN 'abstained' ELSE 'ok' END AS parse_status FROM rec""",
)
def triage_records(spark, sf):
    return records(spark, sf).select(
        "ticket_id", "predicted_queue", "generated_answer", "needs_human_review",
        F.round("confidence_score", 6).alias("confidence_score"), "parse_status",
    )


@query(
    "triage_responses",
    f"WITH {RECORDS_SQL} SELECT ticket_id, predicted_queue, generated_answer, needs_human_review, round(confidence_score, 6) AS confidence_score FROM rec",
)
def triage_responses(spark, sf):
    return T.public_response(records(spark, sf)).withColumn("confidence_score", F.round("confidence_score", 6))


@query(
    "retrieved_payload",
    f"""WITH {Q.CASE_NEIGHBORS} SELECT n.query_id AS ticket_id, CAST(n.rank AS INTEGER) AS rank, c.subject, c.body, c.answer, c.queue, round(greatest(0.0, least(n.score, 1.0)), 6) AS score
FROM nn n JOIN v_cases c ON c.ticket_id = n.neighbor_id""",
)
def retrieved_payload(spark, sf):
    asked, corpus = split_cases(spark, sf)
    return T.retrieve(asked, corpus).select("ticket_id", F.inline("retrieved")).withColumn("score", F.round("score", 6))


@query(
    "abstention",
    f"""WITH {Q.VECTOR_NEIGHBORS}, t AS (SELECT p.ticket_id, greatest(0.0, least(coalesce(n.score, 0.0), 1.0)) AS s, coalesce(n.neighbor_queue, 'Unknown') AS q
  FROM parts p LEFT JOIN nn n ON n.query_id = p.ticket_id AND n.rank = 1 WHERE p.split = 'test')
SELECT ticket_id, round(s, 6) AS confidence_score, q AS nearest_queue, s < {Q.VECTOR_THRESHOLD} AS needs_human_review FROM t""",
)
def abstention(spark, sf):
    from ticketloom.plans.retrieval_queries import searched

    asked, found = searched(spark, sf, 1)
    blank = F.lit(None).cast("string")
    payload = found.withColumns({f"neighbor_{c}": blank for c in ("subject", "body", "answer")})
    listed = R.retrieved_list(payload).withColumnRenamed("query_id", "ticket_id")
    gated = T.gate(asked.select("ticket_id").join(listed, "ticket_id", "left"), Q.VECTOR_THRESHOLD)
    return gated.select(
        "ticket_id", F.round("confidence_score", 6).alias("confidence_score"), "nearest_queue", "needs_human_review"
    )


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_before, _after = J.PROMPT_OPENING.split("{count}")
_PROMPTS = f"""{RECORDS_SQL},
ql AS (SELECT string_agg({_sql_text(J.QUEUE_BULLET)} || queue, chr(10) ORDER BY queue) AS queues FROM (SELECT DISTINCT queue FROM v_cases) d),
ctx AS (SELECT n.query_id, count(*) AS n, string_agg('[Ticket ' || n.rank || ']' || chr(10) || 'Queue: ' || c.queue || chr(10) || 'Body: ' || c.body || chr(10) || 'Answer: ' || c.answer, {_sql_text(J.BLOCK_SEPARATOR)} ORDER BY n.rank) AS blocks
  FROM nn n JOIN v_cases c ON c.ticket_id = n.neighbor_id GROUP BY 1)"""


@query(
    "prompt_text",
    f"""WITH {_PROMPTS} SELECT r.ticket_id, {_sql_text(_before)} || x.n || {_sql_text(_after)} || ql.queues || chr(10) || {_sql_text(J.PROMPT_ANSWER_RULE)} || x.blocks ||
  {_sql_text(chr(10) + '---' + chr(10) + chr(10) + 'New ticket:' + chr(10) + 'Subject: ')} || coalesce(nullif(r.subject, ''), 'N/A') || chr(10) || 'Body: ' || r.body || chr(10) || chr(10) || {_sql_text(J.PROMPT_CLOSING)} AS prompt
FROM rec r JOIN ctx x ON x.query_id = r.ticket_id CROSS JOIN ql WHERE NOT r.needs_human_review""",
)
def prompt_text(spark, sf):
    asked, corpus = split_cases(spark, sf)
    gated = T.gate(T.retrieve(asked, corpus), Q.CASE_THRESHOLD)
    queues = M.label_list(views.cases(spark, sf))
    return T.add_prompt(gated, queues).where(F.col("prompt").isNotNull()).select("ticket_id", "prompt")


@query(
    "draft_answers",
    f"WITH {RECORDS_SQL} SELECT ticket_id, nearest_queue AS reply_queue, nearest_answer AS reply_answer FROM rec WHERE NOT needs_human_review",
)
def draft_answers(spark, sf):
    asked, corpus = split_cases(spark, sf)
    queues = M.label_list(views.cases(spark, sf))
    asked_for = T.generate(T.add_prompt(T.gate(T.retrieve(asked, corpus), Q.CASE_THRESHOLD), queues))
    return T.parse_replies(asked_for).where(F.col("parse_status") == "ok").select("ticket_id", "reply_queue", "reply_answer")


@query(
    "rerank_jaccard",
    f"""WITH {Q.CASE_NEIGHBORS},
ct AS (SELECT ticket_id, list_distinct(list_filter(string_split({Q.clean('body')}, ' '), lambda x: x <> '')) AS toks FROM v_cases),
s AS (SELECT n.query_id, n.neighbor_id, n.rank, CASE WHEN len(a.toks) + len(b.toks) > 0 THEN len(list_intersect(a.toks, b.toks)) / len(list_distinct(list_concat(a.toks, b.toks))) ELSE 0 END AS js
  FROM nn n JOIN ct a ON a.ticket_id = n.query_id JOIN ct b ON b.ticket_id = n.neighbor_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY js DESC, rank) AS pos FROM s)
SELECT query_id, neighbor_id, CAST(rank AS INTEGER) AS rank, CAST(pos AS INTEGER) AS rerank_position, round(js, 6) AS rerank_score FROM r WHERE pos <= 3""",
)
def rerank_jaccard(spark, sf):
    """Five retrieved, three kept."""
    asked, corpus = split_cases(spark, sf)
    found = R.attach_payload(R.nearest(asked, corpus, corpus_extra=()), corpus, ["clean_body"])
    pairs = found.join(asked.select(F.col("ticket_id").alias("query_id"), "clean_body"), "query_id")
    kept = R.rerank(pairs, T.overlap_score(F.col("clean_body"), F.col("neighbor_clean_body")), 3)
    return kept.select("query_id", "neighbor_id", "rank", "rerank_position", F.round("rerank_score", 6).alias("rerank_score"))


_TOKENS = "list_distinct(list_filter(regexp_split_to_array({}, '\\s+'), lambda x: x <> ''))"


@query(
    "triage_reranked",
    f"""WITH {Q.CASE_NEIGHBORS},
ct AS (SELECT ticket_id, queue, answer, {_TOKENS.format(Q.clean('body'))} AS asked, {_TOKENS.format('body')} AS held FROM v_cases),
s AS (SELECT n.query_id, n.score, n.rank, b.queue, b.answer, CASE WHEN len(a.asked) + len(b.held) > 0 THEN len(list_intersect(a.asked, b.held)) / len(list_distinct(list_concat(a.asked, b.held))) ELSE 0 END AS js
  FROM nn n JOIN ct a ON a.ticket_id = n.query_id JOIN ct b ON b.ticket_id = n.neighbor_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY js DESC, rank) AS pos FROM s),
g AS (SELECT p.ticket_id, p.subject, p.body, p.answer, p.queue, greatest(0.0, least(coalesce(f.score, 0.0), 1.0)) AS best, coalesce(f.queue, 'Unknown') AS nearest_queue, t.queue AS top_queue, t.answer AS top_answer
  FROM parts p LEFT JOIN r f ON f.query_id = p.ticket_id AND f.rank = 1 LEFT JOIN r t ON t.query_id = p.ticket_id AND t.pos = 1 WHERE p.split = 'test')
SELECT ticket_id, subject, body, answer, queue, {Q.clean('body')} AS clean_body, CASE WHEN best < {Q.CASE_THRESHOLD} THEN nearest_queue ELSE top_queue END AS predicted_queue,
  CASE WHEN best >= {Q.CASE_THRESHOLD} THEN top_answer END AS generated_answer, best < {Q.CASE_THRESHOLD} AS needs_human_review, round(best, 6) AS confidence_score,
  CASE WHEN best < {Q.CASE_THRESHOLD} THEN 'abstained' ELSE 'ok' END AS parse_status, CASE WHEN best >= {Q.CASE_THRESHOLD} THEN true END AS queue_is_valid FROM g""",
)
def triage_reranked(spark, sf):
    """The gate looks at the first pass; the answer comes from the ticket that the second score puts first."""
    return records(spark, sf, rerank=True).drop("retrieved").withColumn("confidence_score", F.round("confidence_score", 6))


@query(
    "parse_responses",
    f"""WITH {Q.REPLIES}, s0 AS (SELECT ticket_id, regexp_extract(raw, '(?s)\\{{.*\\}}') AS span FROM v_replies),
s AS (SELECT ticket_id, span, CASE WHEN json_valid(span) THEN span END AS js FROM s0),
k AS (SELECT *, CASE WHEN span = '' THEN 'no_object' WHEN js IS NULL THEN 'invalid_json'
  WHEN NOT (list_contains(json_keys(js), 'predicted_queue') AND list_contains(json_keys(js), 'generated_answer')) THEN 'missing_key' ELSE 'ok' END AS parse_status FROM s)
SELECT ticket_id, parse_status, CASE WHEN parse_status = 'ok' THEN json_extract_string(js, '$.predicted_queue') END AS reply_queue,
  CASE WHEN parse_status = 'ok' THEN json_extract_string(js, '$.generated_answer') END AS reply_answer,
  CASE WHEN parse_status = 'ok' THEN json_extract_string(js, '$.predicted_queue') IN (SELECT event_type FROM events) END AS queue_is_valid FROM k""",
)
def parse_responses(spark, sf):
    from ticketloom.sources.tables import read_table

    known = M.label_list(read_table(spark, sf, "events"), "event_type")
    return T.parse_replies(views.replies(spark, sf), "raw", known)


def _bleu_sql(source: str, hyp: str, ref: str) -> str:
    """CTEs ending in bl: ticket_id, bleu."""
    toks = lambda c: f"list_filter(string_split_regex(lower({c}), '\\s+'), lambda x: x <> '')"
    grams = lambda c: f"SELECT ticket_id, n, unnest(list_transform(range(1, len({c}) - n + 2), lambda i: array_to_string({c}[i:i + n - 1], ' '))) AS gram FROM bt, (SELECT unnest([1, 2, 3, 4]) AS n) g"
    return f"""bt AS (SELECT ticket_id, {toks(hyp)} AS h, {toks(ref)} AS r FROM {source} WHERE {hyp} IS NOT NULL AND {ref} IS NOT NULL),
hg AS (SELECT ticket_id, n, gram, count(*) AS c FROM ({grams('h')}) t GROUP BY ALL), rg AS (SELECT ticket_id, n, gram, count(*) AS c FROM ({grams('r')}) t GROUP BY ALL),
pn AS (SELECT h.ticket_id, h.n, sum(least(h.c, coalesce(r.c, 0))) AS num, sum(h.c) AS den FROM hg h LEFT JOIN rg r USING (ticket_id, n, gram) GROUP BY 1, 2),
pa AS (SELECT b.ticket_id, len(b.h) AS hn, len(b.r) AS rn, g.n, coalesce(num, 0) AS num, greatest(coalesce(den, 0), 1) AS den FROM bt b CROSS JOIN (SELECT unnest([1, 2, 3, 4]) AS n) g LEFT JOIN pn p ON p.ticket_id = b.ticket_id AND p.n = g.n),
bl AS (SELECT ticket_id, round(CASE WHEN max(hn) = 0 OR max(num) FILTER (n = 1) = 0 THEN 0.0
  ELSE exp(CASE WHEN max(hn) > max(rn) THEN 0 ELSE 1 - max(rn) / max(hn) END + sum(ln(CASE WHEN num > 0 THEN num ELSE 0.1 END / den)) / 4) END, 4) AS bleu FROM pa GROUP BY ticket_id)"""


def _rouge_sql(source: str, hyp: str, ref: str, stemmed: bool = False) -> str:
    """CTEs ending in rl: ticket_id, lcs, rouge_l; one table row of the LCS per recursion step."""
    toks = lambda c: f"regexp_extract_all(lower({c}), '[a-z0-9]+')"
    found = f"SELECT ticket_id, {toks(hyp)} AS h, {toks(ref)} AS r FROM {source} WHERE {hyp} IS NOT NULL AND {ref} IS NOT NULL"
    texts = f"rt AS ({found})"
    if stemmed:
        side = lambda c: f"(SELECT ticket_id, list(x ORDER BY nth) AS {c} FROM (SELECT ticket_id, unnest({c}) AS w, generate_subscripts({c}, 1) AS nth FROM rw) JOIN stems USING (w) GROUP BY 1)"
        texts = f"""rw AS ({found}), words AS (SELECT DISTINCT unnest(list_concat(h, r)) AS w FROM rw),
{stems('words')},
rt AS (SELECT ticket_id, coalesce(a.h, []) AS h, coalesce(b.r, []) AS r FROM rw LEFT JOIN {side('h')} a USING (ticket_id) LEFT JOIN {side('r')} b USING (ticket_id))"""
    return f"""{texts},
lc AS (SELECT ticket_id, h, r, 0 AS i, list_transform(range(0, len(r) + 1), lambda x: CAST(0 AS BIGINT)) AS p FROM rt
  UNION ALL SELECT ticket_id, h, r, i + 1, list_transform(range(1, len(r) + 2), lambda j: list_max(c[1:j])) FROM (
    SELECT ticket_id, h, r, i, list_transform(range(1, len(r) + 2), lambda j: CASE WHEN j > 1 AND r[j - 1] = h[i + 1] THEN greatest(p[j], p[j - 1] + 1) ELSE p[j] END) AS c FROM lc WHERE i < len(h)) t),
rl AS (SELECT ticket_id, p[len(r) + 1] AS lcs, round(CASE WHEN p[len(r) + 1] > 0 THEN 2 * p[len(r) + 1] / (len(h) + len(r)) ELSE 0 END, 4) AS rouge_l FROM lc WHERE i = len(h))"""


@query("bleu_pairs", f"WITH {Q.ANSWERED}, {_bleu_sql('v_pairs', 'body', 'answer')} SELECT ticket_id, bleu FROM bl")
def bleu_pairs(spark, sf):
    return O.bleu(views.answered(spark, sf), "answer", "body")


@query("rouge_l_pairs", f"WITH RECURSIVE {Q.ANSWERED}, {_rouge_sql('v_pairs', 'body', 'answer')} SELECT ticket_id, lcs, rouge_l FROM rl")
def rouge_l_pairs(spark, sf):
    return O.rouge_l(views.answered(spark, sf), "answer", "body", stemmed=False)


@query("rouge_l_stemmed", f"WITH RECURSIVE {Q.ANSWERED}, {_rouge_sql('v_pairs', 'body', 'answer', stemmed=True)} SELECT ticket_id, lcs, rouge_l FROM rl")
def rouge_l_stemmed(spark, sf):
    return O.rouge_l(views.answered(spark, sf), "answer", "body", stemmed=True)


@query(
    "mean_text_overlap",
    f"""WITH RECURSIVE {Q.ANSWERED}, {_bleu_sql('v_pairs', 'body', 'answer')}, {_rouge_sql('v_pairs', 'body', 'answer')}
SELECT count(bleu) AS scored, round(avg(bleu), 4) AS mean_bleu, round(avg(rouge_l), 4) AS mean_rouge_l FROM bl JOIN rl USING (ticket_id)""",
)
def mean_text_overlap(spark, sf):
    return O.mean_overlap(O.text_overlap(views.answered(spark, sf), "answer", "body", stemmed=False))


_SUMMARY = f"""{RECORDS_SQL}, {Q.class_counts('rec')}, ans AS (SELECT ticket_id, answer, generated_answer FROM rec WHERE NOT needs_human_review),
{_bleu_sql('ans', 'generated_answer', 'answer')}, {_rouge_sql('ans', 'generated_answer', 'answer')},
c AS (SELECT count(*) AS tickets, count(*) FILTER (needs_human_review) AS abstained FROM rec)"""


@query(
    "rag_eval_summary",
    f"""WITH RECURSIVE {_SUMMARY}
SELECT 'sample_size' AS metric, CAST(tickets + abstained AS DOUBLE) AS value FROM c UNION ALL SELECT 'tickets', tickets FROM c UNION ALL SELECT 'abstained', abstained FROM c
UNION ALL SELECT 'scored_queues', tickets FROM c UNION ALL SELECT 'abstention_rate_ref', round(abstained / (tickets + abstained), 4) FROM c UNION ALL SELECT 'abstention_rate', round(abstained / tickets, 4) FROM c
UNION ALL SELECT 'queue_accuracy', round(sum(tp) / sum(support), 4) FROM cc_f UNION ALL SELECT 'queue_weighted_f1', round(sum(support * f1) / sum(support), 4) FROM cc_f
UNION ALL SELECT 'scored_answers', count(bleu) FROM bl UNION ALL SELECT 'mean_bleu', round(avg(bleu), 4) FROM bl UNION ALL SELECT 'mean_rouge_l', round(avg(rouge_l), 4) FROM rl""",
)
def rag_eval_summary(spark, sf):
    return T.evaluation_summary(records(spark, sf), stemmed=False)
