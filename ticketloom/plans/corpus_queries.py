"""Cleaning, quality gates and corpus layout."""

from __future__ import annotations

from pyspark.sql import functions as F

from ticketloom.functions import text as X
from ticketloom.operators import corpus as C
from ticketloom.operators import quality as G
from ticketloom.plans import fragments as Q
from ticketloom.plans.registry import query
from ticketloom.sources import tables as IO
from ticketloom.sources import views
from ticketloom.scale import materialize, scratch_path, spread


def cleaned(spark, sf):
    """English tickets, cleaned, within the length limits, all columns kept."""
    return C.filter_body_length(C.add_clean_columns(C.filter_language(views.tickets(spark, sf))))


def stored_corpus(spark, sf):
    """The cleaned corpus as a written table, for jobs that read it more than once."""
    return materialize(cleaned(spark, sf).select("ticket_id", "queue", "clean_body"), "corpus")


@query("clean_corpus", f"WITH {Q.CLEANED} SELECT ticket_id, body, queue, clean_body, length(body) AS body_length FROM v_clean")
def clean_corpus(spark, sf):
    return C.clean_corpus(views.tickets(spark, sf))


@query("clean_html_pages", f"SELECT page_id, {Q.clean('html', strip_html=True)} AS clean_html FROM pages")
def clean_html_pages(spark, sf):
    pages = spread(IO.read_table(spark, sf, "pages"), "page_id")
    return pages.select("page_id", X.clean_text(F.col("html"), strip_html=True).alias("clean_html"))


@query(
    "length_filter_audit",
    f"""WITH {Q.TICKETS}, c AS (SELECT *, {Q.clean('body')} AS clean_body FROM v_tickets WHERE language = 'en')
SELECT count(*) AS total_rows, count(*) FILTER (length(clean_body) < 30) AS too_short, count(*) FILTER (length(clean_body) > 5000) AS too_long,
  count(*) FILTER (length(clean_body) BETWEEN 30 AND 5000) AS kept, count(*) FILTER (length(body) < 50) AS short_bodies, count(*) FILTER (length(body) > 3000) AS long_bodies FROM c""",
)
def length_filter_audit(spark, sf):
    return G.length_audit(C.add_clean_columns(C.filter_language(views.tickets(spark, sf))))


@query(
    "null_counts",
    f"""WITH {Q.TAGGED} SELECT * FROM (
  SELECT 'ticket_id' AS "column", count(*) - count(ticket_id) AS nulls FROM v_tags UNION ALL SELECT 'queue', count(*) - count(queue) FROM v_tags
  UNION ALL SELECT 'tag_1', count(*) - count(tag_1) FROM v_tags UNION ALL SELECT 'tag_2', count(*) - count(tag_2) FROM v_tags
  UNION ALL SELECT 'tag_3', count(*) - count(tag_3) FROM v_tags) t WHERE nulls > 0""",
)
def null_counts(spark, sf):
    return G.null_counts(views.tagged(spark, sf))


@query(
    "full_row_duplicates",
    f"""WITH {Q.TICKETS}, t AS (SELECT body, language, queue FROM v_tickets)
SELECT (SELECT count(*) FROM t) AS total_rows, (SELECT count(*) FROM t) - (SELECT count(*) FROM (SELECT DISTINCT * FROM t) d) AS duplicate_rows""",
)
def full_row_duplicates(spark, sf):
    return G.full_row_duplicates(views.tickets(spark, sf).drop("ticket_id"))


@query(
    "duplicate_bodies",
    f"WITH {Q.TICKETS} SELECT count(*) AS total_rows, count(DISTINCT body) AS distinct_bodies, count(*) - count(DISTINCT body) AS duplicate_bodies FROM v_tickets",
)
def duplicate_bodies(spark, sf):
    return G.duplicate_bodies(views.tickets(spark, sf))


_LABELS = "b AS (SELECT body, count(DISTINCT queue) AS labels, count(*) AS copies FROM v_tickets WHERE body IS NOT NULL GROUP BY body)"


@query(
    "label_conflicts",
    f"WITH {Q.TICKETS}, {_LABELS} SELECT count(*) AS bodies, count(*) FILTER (labels > 1) AS conflicting_bodies, round(avg(CASE WHEN labels = 1 THEN 1 ELSE 0 END), 4) AS single_label_share FROM b",
)
def label_conflicts(spark, sf):
    return G.label_conflicts(views.tickets(spark, sf))


@query(
    "label_consistency",
    f"WITH {Q.TICKETS}, {_LABELS} SELECT sha256(body) AS body_key, labels, CAST(copies AS BIGINT) AS copies FROM b WHERE labels > 1 ORDER BY labels DESC, body_key LIMIT 10",
)
def label_consistency(spark, sf):
    return G.worst_conflicts(views.tickets(spark, sf))


@query(
    "drop_repeated_bodies",
    f"WITH {Q.TICKETS} SELECT min(ticket_id) AS ticket_id FROM v_tickets WHERE body IS NOT NULL GROUP BY body UNION ALL SELECT ticket_id FROM v_tickets WHERE body IS NULL",
)
def drop_repeated_bodies(spark, sf):
    return C.drop_repeated_bodies(views.tickets(spark, sf)).select("ticket_id")


_ANSWERS = f"{Q.ANSWERED}, a AS (SELECT clean_answer, count(*) AS copies FROM (SELECT {Q.clean('answer')} AS clean_answer FROM v_pairs) t WHERE clean_answer IS NOT NULL GROUP BY 1)"


@query(
    "answer_quality",
    f"""WITH {_ANSWERS} SELECT CAST(sum(copies) AS BIGINT) AS answers, CAST(coalesce(sum(copies) FILTER (trim(clean_answer) = ''), 0) AS BIGINT) AS empty_answers,
  count(*) AS distinct_answers, count(*) FILTER (copies > 5) AS template_answers, round(avg(CASE WHEN copies > 5 THEN 1 ELSE 0 END), 4) AS template_share,
  round(coalesce(sum(copies) FILTER (copies > 5), 0) / sum(copies), 4) AS template_row_share FROM a""",
)
def answer_quality(spark, sf):
    return G.answer_quality(C.add_clean_columns(views.answered(spark, sf)))


@query(
    "repeated_answers",
    f"WITH {_ANSWERS} SELECT sha256(clean_answer) AS answer_key, copies, substring(clean_answer, 1, 100) AS answer_start FROM a ORDER BY copies DESC, answer_key LIMIT 3",
)
def repeated_answers(spark, sf):
    return G.repeated_answers(C.add_clean_columns(views.answered(spark, sf)))


@query(
    "token_overflow",
    f"""WITH {Q.CLEANED}, t AS (SELECT len(list_filter(string_split(clean_body, ' '), lambda x: x <> '')) + 2 AS n FROM v_clean)
SELECT count(*) AS texts, count(*) FILTER (n > 512) AS over_limit, round(avg(CASE WHEN n > 512 THEN 1 ELSE 0 END), 4) AS over_share, avg(CASE WHEN n > 512 THEN 1 ELSE 0 END) > 0.10 AS notable FROM t""",
)
def token_overflow(spark, sf):
    return G.token_overflow(cleaned(spark, sf))


def _hits(words):
    listed = ", ".join(f"'{w}'" for w in words)
    return f"len(list_filter(toks, lambda x: x IN ({listed})))"


_GUESS = f"""g AS (SELECT doc_id, lang, CASE WHEN text IS NULL OR greatest({', '.join(l for l in X.LANGUAGE_WORDS)}) = 0 THEN 'unknown'
  {' '.join(f"WHEN {l} = greatest({', '.join(X.LANGUAGE_WORDS)}) THEN '{l}'" for l in sorted(X.LANGUAGE_WORDS))} END AS detected
  FROM (SELECT doc_id, lang, text, {', '.join(f"{_hits(w)} AS {l}" for l, w in X.LANGUAGE_WORDS.items())}
    FROM (SELECT *, regexp_extract_all(lower(text), '\\p{{L}}+') AS toks FROM documents) s) t)"""


@query(
    "language_agreement",
    f"WITH {_GUESS} SELECT count(*) AS texts, count(*) FILTER (detected = lang) AS agreeing, round(avg(CASE WHEN detected = lang THEN 1 ELSE 0 END), 4) AS agreement FROM g",
)
def language_agreement(spark, sf):
    return G.language_agreement(views.tickets(spark, sf))


@query(
    "language_mismatches",
    f"WITH {_GUESS} SELECT doc_id AS ticket_id, lang AS language, detected FROM g WHERE detected IS DISTINCT FROM lang",
)
def language_mismatches(spark, sf):
    return G.language_mismatches(views.tickets(spark, sf))


@query(
    "vector_norm_check",
    """WITH n AS (SELECT len(embedding) AS dim, sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS norm FROM embeddings WHERE embedding IS NOT NULL)
SELECT count(*) AS vectors, CAST(min(dim) AS INTEGER) AS min_dim, CAST(max(dim) AS INTEGER) AS max_dim, round(min(norm), 6) AS min_norm, round(max(norm), 6) AS max_norm, round(avg(norm), 6) AS mean_norm,
  count(*) FILTER (abs(norm - 1) > 1e-3) AS off_unit FROM n""",
)
def vector_norm_check(spark, sf):
    return G.vector_norms(views.vectors(spark, sf))


@query(
    "alignment_check",
    """SELECT (SELECT count(*) FROM documents) AS left_rows, (SELECT count(*) FROM labels) AS right_rows,
  (SELECT count(*) FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels) a) AS only_left,
  (SELECT count(*) FROM (SELECT doc_id FROM labels EXCEPT SELECT doc_id FROM documents) b) AS only_right""",
)
def alignment_check(spark, sf):
    return IO.alignment_report(IO.read_table(spark, sf, "documents"), IO.read_table(spark, sf, "labels"), "doc_id")


@query(
    "subject_weighted_text",
    f"WITH {Q.ANSWERED} SELECT ticket_id, coalesce(subject, '') || ' ' || coalesce(subject, '') || ' ' || coalesce(clean_body, '') AS text FROM (SELECT *, {Q.clean('body')} AS clean_body FROM v_pairs) t",
)
def subject_weighted_text(spark, sf):
    df = C.add_clean_columns(views.answered(spark, sf))
    return df.select("ticket_id", C.subject_weighted_text(F.col("subject"), C.text_column(df)).alias("text"))


@query(
    "request_validation",
    f"""WITH {Q.TICKETS} SELECT ticket_id, CASE WHEN body IS NULL THEN 'missing_body' WHEN length(body) < 1 THEN 'empty_body' WHEN length(body) > 5000 THEN 'body_too_long' END AS reject_reason FROM v_tickets""",
)
def request_validation(spark, sf):
    return C.validate_requests(views.tickets(spark, sf)).select("ticket_id", "reject_reason")


def _lemma_sql(cleaned_rows: str, surface: str = "''") -> str:
    return f"""{cleaned_rows},
toks AS (SELECT ticket_id, unnest(string_split(clean_body, ' ')) AS token, generate_subscripts(string_split(clean_body, ' '), 1) AS pos FROM v_clean),
words AS (SELECT DISTINCT token FROM toks WHERE token <> ''),
opts AS (SELECT token, 0 AS o, left(token, length(token) - 3) AS lemma FROM words WHERE token LIKE '%ing' AND length(token) >= 6
  UNION ALL SELECT token, 1, left(token, length(token) - 2) FROM words WHERE token LIKE '%ed' AND length(token) >= 5
  UNION ALL SELECT token, 2, left(token, length(token) - 2) FROM words WHERE token LIKE '%es' AND length(token) >= 5
  UNION ALL SELECT token, 3, left(token, length(token) - 1) FROM words WHERE token LIKE '%s' AND length(token) >= 4),
lemmas AS (SELECT o.token, arg_min(o.lemma, o.o) AS lemma FROM opts o JOIN words w ON w.token = o.lemma GROUP BY o.token),
lemmatized AS (SELECT v.ticket_id, v.queue, v.clean_body, coalesce(l.body, '') AS lemmatized_body FROM v_clean v LEFT JOIN
  (SELECT t.ticket_id, string_agg(coalesce(m.lemma, t.token), ' ' ORDER BY t.pos) AS body FROM toks t LEFT JOIN lemmas m ON m.token = t.token
   WHERE length(t.token) >= 3 AND coalesce(m.lemma, t.token) NOT IN ({Q.STOP_LIST}) AND t.token NOT IN ({surface}) GROUP BY t.ticket_id) l ON l.ticket_id = v.ticket_id)"""


_LEMMAS = _lemma_sql(Q.CLEANED)


def lemmatized(spark, sf):
    tickets = stored_corpus(spark, sf)
    lemmas = C.suffix_lemmas(tickets)
    return C.map_distinct(tickets, "clean_body", "lemmatized_body", lambda texts: C.lemmatize(texts, lemmas))


@query("lemma_map_back", f"WITH {_LEMMAS} SELECT ticket_id, lemmatized_body FROM lemmatized")
def lemma_map_back(spark, sf):
    return lemmatized(spark, sf).select("ticket_id", "lemmatized_body")


@query("lemma_table", f"WITH {_LEMMAS} SELECT token, lemma FROM lemmas")
def lemma_table(spark, sf):
    return C.suffix_lemmas(cleaned(spark, sf))


_GENERAL = ", ".join(f"'{w}'" for w in X.GENERAL_STOP_WORDS)
_FULL = f"""{Q.ANSWERED}, {Q.ATTRIBUTES}, {Q.TAGGED},
v_full AS (SELECT p.ticket_id, p.subject, p.body, p.answer, a.type, d.source AS queue, a.priority, g.tag_1, g.tag_2, g.tag_3, d.lang AS language
  FROM v_pairs p LEFT JOIN documents d ON d.doc_id = p.conv_id LEFT JOIN v_attr a ON a.ticket_id = p.conv_id LEFT JOIN v_tags g ON g.ticket_id = p.conv_id % 200 + 1),
v_clean AS (SELECT * FROM (SELECT *, {Q.clean('body')} AS clean_body, {Q.clean('answer')} AS clean_answer FROM v_full WHERE language = 'en') t WHERE length(clean_body) BETWEEN 30 AND 5000)"""


@query(
    "build_corpus",
    f"""WITH {_lemma_sql(_FULL, _GENERAL)}
SELECT c.ticket_id, subject, body, answer, type, c.queue, priority, tag_1, tag_2, tag_3, c.clean_body, clean_answer, lemmatized_body,
  length(body) AS body_length, length(answer) AS answer_length, length(clean_answer) AS clean_answer_length
FROM v_clean c JOIN lemmatized l ON l.ticket_id = c.ticket_id""",
)
def build_corpus(spark, sf):
    """Raw tickets with answers, attributes and tags to the full corpus layout, over a store of lemmatised texts.

    A first run fills the store from half of the tickets; the second works what is new and gives the corpus.
    """
    raw = views.full_tickets(spark, sf)
    store = scratch_path(spark, "lemma-store")
    every = C.suffix_lemmas(C.add_clean_columns(C.filter_language(raw)).transform(C.filter_body_length))
    C.build_corpus(raw.where(F.col("ticket_id") % 2 == 0), lambda _: every, store)
    return C.build_corpus(raw, lambda _: every, store)


@query(
    "io_roundtrip",
    f"WITH {Q.ANSWERED} SELECT ticket_id, subject, body, answer, lower(substring(answer, 1, 100)) AS answer_start, length(body) AS body_length, length(answer) AS answer_length FROM v_pairs",
)
def io_roundtrip(spark, sf):
    """Out to CSV, JSON and parquet and back, each step reading what the one before wrote."""
    rows = views.answered(spark, sf).select("ticket_id", "subject", "body", "answer")
    path = scratch_path(spark, "roundtrip")
    IO.write_csv(rows, f"{path}/csv")
    back = IO.read_csv(spark, f"{path}/csv", rows.schema)
    IO.write_report(back, f"{path}/json")
    IO.write_table(IO.read_report(spark, f"{path}/json", rows.schema), f"{path}/table")
    stored = spark.read.schema(rows.schema).parquet(f"{path}/table")
    return C.add_length_columns(stored.withColumn("answer_start", F.lower(X.prefix(F.col("answer")))))
