"""The named queries of this subpackage, with production parameters, and the SQL of those SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ticketloom.llm import collocations, grouped_packing, packing, periodic_runs, personal_data, positional_index, quality_ranking, rans, segment_search, sentence_spans, shingle_join, token_counts, toxicity
from ticketloom.llm.tables import documents, read_table

QUERIES = {}
ORACLES = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


@query("op1_toxicity")
def toxicity_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), read_table(spark, sf_dir, "labels"), held_out_parts=3, held_out_part=1, cut=0.7)


@query(
    "op2_topk",
    """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""",
)
def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment_search.top_k(read_table(spark, sf_dir, "embeddings"), every=20, k=20, scale=64.0)


@query("op3_packing")
def packed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), end_id=1, room=2048)


@query("op4_sentence_spans")
def documents_without_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_spans.without_repeats(documents(spark, sf_dir), run=3, min_words=8)


@query("op5_quality")
def quality_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_ranking.quality_scores(documents(spark, sf_dir), read_table(spark, sf_dir, "labels"), held_out_parts=5, cut=0.3)


@query("op6_token_ids")
def stored_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rans.round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


@query("op7_token_counts")
def counted_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"), limit=4096)


_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


@query(
    "op8_decontamination",
    f"""WITH dw AS (SELECT doc_id, {_WORDS} AS w FROM documents),
bw AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (SELECT item_id, least(len(w), 10) AS m, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i, w FROM bw WHERE len(w) > 0),
asked AS (SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS gram FROM win),
runs AS (SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS gram FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM dw, (SELECT DISTINCT m FROM asked) WHERE len(w) >= m)),
hits AS (SELECT doc_id, item_id, i, r.m FROM runs r JOIN asked a ON a.m = r.m AND a.gram = r.gram),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + m)) AS p FROM hits) GROUP BY doc_id),
hit_items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)""",
)
def contaminated_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positional_index.contamination(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"), window=10)


@query("op9_personal_data")
def personal_data_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.digest(personal_data.find(documents(spark, sf_dir)))


@query(
    "op10_jaccard_join",
    r"""WITH RECURSIVE dw AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM dw WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM met JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.b AS component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT a, min(b) AS b FROM reach GROUP BY a) c ON c.a = d.doc_id""",
)
def joined_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.near_duplicates(documents(spark, sf_dir))


@query("op11_periodic_runs")
def periodic_runs_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digest(periodic_runs.find_runs(periodic_runs.periodic_tails(documents(spark, sf_dir))))


@query("op12_grouped_packing")
def packed_by_linear_grouping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouped_packing.pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), end_id=2, room=1024)


@query(
    "op13_collocations",
    r"""WITH t AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM t)),
f AS (SELECT lang, m, w[i:i + m - 1] AS words, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS f FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM p, (SELECT unnest(range(1, 6)) AS m) WHERE len(w) >= m) GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, m, words, phrase, f AS a FROM f WHERE m > 1 AND f >= 100),
cut AS (SELECT c.lang, c.phrase, a, k, l.f AS l, r.f AS r, n, CAST((1000::HUGEINT * a * n) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM c) c JOIN f l ON l.lang = c.lang AND l.m = k AND l.words = c.words[1:k]
  JOIN f r ON r.lang = c.lang AND r.m = c.m - k AND r.words = c.words[k + 1:] JOIN n ON n.lang = c.lang),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (SELECT DISTINCT lang, array_to_string(words[i:i + s - 1], ' ') AS phrase, a FROM (SELECT *, unnest(range(1, m - s + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS s FROM c WHERE m > 2))),
free AS (SELECT best.* FROM best LEFT JOIN inside USING (lang, phrase, a) WHERE inside.phrase IS NULL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM free QUALIFY rank <= 2000""",
)
def collocations_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir), longest=5, min_count=100, keep=2000)


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)
