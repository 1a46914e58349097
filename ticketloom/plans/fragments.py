"""SQL pieces the check queries share."""

from __future__ import annotations

from ticketloom.functions.text import DOMAIN_STOP_WORDS
from ticketloom.settings import DEFAULTS

TICKETS = "v_tickets AS (SELECT doc_id AS ticket_id, text AS body, lang AS language, source AS queue FROM documents)"
ATTRIBUTES = "v_attr AS (SELECT o_orderkey AS ticket_id, o_orderpriority AS priority, o_orderstatus AS type FROM orders)"
TAGGED = """v_tags AS (SELECT p_partkey AS ticket_id, p_type AS queue,
  CASE WHEN p_size % 10 <> 0 THEN p_brand END AS tag_1,
  CASE WHEN p_size % 2 = 0 THEN p_type END AS tag_2,
  CASE WHEN p_size % 5 = 0 THEN lower(p_brand) END AS tag_3 FROM part)"""
VECTORS = "v_vec AS (SELECT vec_id AS ticket_id, embedding, CAST(label AS VARCHAR) AS queue FROM embeddings)"
ANSWERED = """v_pairs AS (SELECT ticket_id, conv_id, turn, CASE WHEN turn = 0 THEN substring(body, 1, 40) END AS subject, body, answer
  FROM (SELECT conv_id * 1000 + turn AS ticket_id, conv_id, turn, role, text AS body,
          lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role,
          lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS answer FROM conversations) t
  WHERE role = 'user' AND next_role = 'assistant')"""
CASES = ANSWERED + """,
v_cases AS (SELECT p.ticket_id, p.subject, p.body, p.answer, d.source AS queue FROM v_pairs p JOIN documents d ON d.doc_id = p.conv_id)"""
REPLIES = """v_replies AS (SELECT event_id AS ticket_id, CASE event_id % 7
  WHEN 0 THEN '{"predicted_queue":"' || event_type || '","generated_answer":"ok"}'
  WHEN 1 THEN 'Sure: {"predicted_queue":"' || event_type || '","generated_answer":"ok"} done'
  WHEN 2 THEN '{"predicted_queue":"' || event_type || '"}'
  WHEN 3 THEN '{"predicted_queue":' || event_type || '}'
  WHEN 4 THEN 'no object here'
  WHEN 5 THEN '{"predicted_queue":"a","generated_answer":"b"} and {more}'
  ELSE '{"predicted_queue":null,"generated_answer":null}' END AS raw FROM events)"""


def clean(column: str, strip_html: bool = False) -> str:
    out = column
    if strip_html:
        out = f"regexp_replace({out}, '<[^>]+>', ' ', 'g')"
    out = f"regexp_replace({out}, 'https?://\\S+|www\\.\\S+', ' ', 'g')"
    out = f"regexp_replace({out}, '\\S+@\\S+\\.\\S+', ' ', 'g')"
    out = f"regexp_replace(lower({out}), '[^a-z0-9\\s]', ' ', 'g')"
    return f"trim(regexp_replace({out}, '\\s+', ' ', 'g'))"


# English tickets, cleaned and inside the length limits.
CLEANED = TICKETS + f""",
v_clean AS (SELECT * FROM (SELECT *, {clean('body')} AS clean_body FROM v_tickets WHERE language = 'en') t
  WHERE length(clean_body) BETWEEN {DEFAULTS.min_body_chars} AND {DEFAULTS.max_body_chars})"""


def _shares(source: str, size: str, quota: str, out: str) -> str:
    return f"""(SELECT * EXCLUDE (_place, _base, _rest),
    CAST(_base + CASE WHEN _place <= _quota - sum(_base) OVER () THEN 1 ELSE 0 END AS BIGINT) AS {out}
  FROM (SELECT *, row_number() OVER (ORDER BY _rest DESC, queue) AS _place
    FROM (SELECT *, floor(_exact) AS _base, round(_exact - floor(_exact), 9) AS _rest
      FROM (SELECT *, CAST(_quota * {size} AS DOUBLE) / CAST(sum({size}) OVER () AS DOUBLE) AS _exact
        FROM (SELECT *, {quota} AS _quota FROM {source})))))"""


def split(source: str, out: str = "parts") -> str:
    """CTEs ending in ``out``: the rows of ``source`` with their split."""
    counts = f"(SELECT queue, CAST(count(*) AS BIGINT) AS n FROM {source} WHERE queue IS NOT NULL GROUP BY queue)"
    first = _shares(counts, "n", "CAST(sum(n) OVER () - ceil(round(sum(n) OVER () * 0.3, 9)) AS BIGINT)", "n_train")
    rest = f"(SELECT queue, n, n_train, n - n_train AS rest_n FROM {out}_s1)"
    second = _shares(rest, "rest_n", "CAST(sum(rest_n) OVER () - ceil(round(sum(rest_n) OVER () * 0.5, 9)) AS BIGINT)", "n_val")
    return f"""{out}_s1 AS {first},
{out}_s2 AS {second},
{out}_rn AS (SELECT *, row_number() OVER (PARTITION BY queue ORDER BY md5(concat_ws(':', CAST(ticket_id AS VARCHAR), '{DEFAULTS.seed}')), ticket_id) AS _rn FROM {source}),
{out} AS (SELECT r.* EXCLUDE (_rn), CASE WHEN r.queue IS NULL THEN NULL WHEN r._rn <= s.n_train THEN 'train' WHEN r._rn <= s.n_train + s.n_val THEN 'val' ELSE 'test' END AS split
  FROM {out}_rn r LEFT JOIN {out}_s2 s ON r.queue = s.queue)"""


def neighbors(source: str, k: int = 10, queries: str = "test", out: str = "nn") -> str:
    """CTEs ending in ``out``: k nearest train rows of every query row of ``source``."""
    return f"""{out}_sim AS (SELECT q.ticket_id AS query_id, c.ticket_id AS neighbor_id, q.queue AS query_queue, c.queue AS neighbor_queue,
    round(list_dot_product(CAST(q.embedding AS DOUBLE[]), CAST(c.embedding AS DOUBLE[])), 9) AS score
  FROM {source} q JOIN {source} c ON q.split = '{queries}' AND c.split = 'train'),
{out} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, neighbor_id) AS rank FROM {out}_sim) t WHERE rank <= {k})"""


def vote(source: str, k: int, nn: str = "nn", queries: str = "test", out: str = "votes") -> str:
    """CTEs ending in ``out``: ticket_id, queue, predicted_queue, votes."""
    return f"""{out}_c AS (SELECT query_id, neighbor_queue, count(*) AS votes, min(rank) AS best_rank FROM {nn} WHERE rank <= {k} GROUP BY 1, 2),
{out}_w AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY votes DESC, best_rank) AS rn FROM {out}_c) t WHERE rn = 1),
{out} AS (SELECT s.ticket_id, s.queue, coalesce(w.neighbor_queue, 'Unknown') AS predicted_queue, coalesce(w.votes, 0) AS votes
  FROM {source} s LEFT JOIN {out}_w w ON w.query_id = s.ticket_id WHERE s.split = '{queries}')"""


def class_counts(source: str, out: str = "cc", truth: str = "queue", predicted: str = "predicted_queue", by: str = "") -> str:
    b = f"{by}, " if by else ""
    g = "1, 2" if by else "1"
    return f"""{out} AS (SELECT {b}label, CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(p) AS BIGINT) AS predicted, CAST(sum(s) AS BIGINT) AS support FROM (
    SELECT {b}{truth} AS label, CASE WHEN {truth} = {predicted} THEN 1 ELSE 0 END AS tp, 0 AS p, 1 AS s FROM {source}
    UNION ALL SELECT {b}{predicted}, 0, 1, 0 FROM {source}) t GROUP BY {g}),
{out}_f AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS "precision",
    CASE WHEN support > 0 THEN tp / support ELSE 0 END AS recall,
    CASE WHEN predicted + support > 0 THEN 2 * tp / (predicted + support) ELSE 0 END AS f1 FROM {out})"""


WEIGHTED = """round(sum(tp) / sum(support), 4) AS accuracy, round(sum(support * "precision") / sum(support), 4) AS "precision",
  round(sum(support * recall) / sum(support), 4) AS recall, round(sum(support * f1) / sum(support), 4) AS f1"""

VECTOR_NEIGHBORS = VECTORS + ",\n" + split("v_vec") + ",\n" + neighbors("parts")
VECTOR_VOTES = VECTOR_NEIGHBORS + ",\n" + vote("parts", DEFAULTS.top_k)
STOP_LIST = ", ".join(f"'{w}'" for w in DOMAIN_STOP_WORDS)


def hashed(source: str, dim: int = DEFAULTS.embedding_dim) -> str:
    """CTEs ``source``_cells (ticket_id, place, x) and ``source``_emb (ticket_id, embedding)."""
    s = source
    return f"""{s}_tf AS (SELECT ticket_id, term, count(*) AS tf FROM (SELECT ticket_id, unnest(regexp_extract_all({clean('body')}, '[a-z0-9]{{2,}}')) AS term FROM {s}) t GROUP BY ALL),
{s}_x AS (SELECT ticket_id, CAST('0x' || substring(h, 1, 8) AS BIGINT) % {dim} AS place, sum(CASE WHEN substring(h, 9, 1) >= '8' THEN 1.0 ELSE -1.0 END * (1 + ln(tf))) AS x
  FROM (SELECT *, md5(term) AS h FROM {s}_tf) t GROUP BY 1, 2),
{s}_l AS (SELECT ticket_id, sqrt(sum(x * x)) AS len FROM {s}_x GROUP BY 1),
{s}_cells AS (SELECT d.ticket_id, g.place, CAST(CASE WHEN l.len > 0 THEN coalesce(x.x, 0) / l.len ELSE 0 END AS FLOAT) AS x
  FROM {s} d CROSS JOIN (SELECT unnest(range({dim})) AS place) g LEFT JOIN {s}_x x ON x.ticket_id = d.ticket_id AND x.place = g.place LEFT JOIN {s}_l l ON l.ticket_id = d.ticket_id),
{s}_emb AS (SELECT ticket_id, list(x ORDER BY place) AS embedding FROM {s}_cells GROUP BY ticket_id)"""


# Abstention limits at which the stand-in texts and vectors split into both outcomes; the default of
# the library stays 0.55.
CASE_THRESHOLD = 0.35
VECTOR_THRESHOLD = 0.40

# Cases with vectors and split, and the five nearest train cases of every test case.
CASE_NEIGHBORS = (
    CASES + ",\n" + hashed("v_cases") + """,
case_vec AS (SELECT c.*, e.embedding FROM v_cases c JOIN v_cases_emb e ON e.ticket_id = c.ticket_id),
""" + split("case_vec") + ",\n" + neighbors("parts", DEFAULTS.top_k)
)
