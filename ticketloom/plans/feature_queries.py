"""TF-IDF and text vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from ticketloom.operators import features as E
from ticketloom.operators import split as S
from ticketloom.operators.corpus import add_clean_columns
from ticketloom.plans import fragments as Q
from ticketloom.plans.corpus_queries import stored_corpus
from ticketloom.plans.registry import query
from ticketloom.settings import DEFAULTS
from ticketloom.sources import views


def _tfidf_sql(max_features: int = DEFAULTS.max_features) -> str:
    return f"""{Q.CLEANED},
{Q.split('v_clean')},
tok AS (SELECT ticket_id, split, regexp_extract_all(clean_body, '[a-z0-9]{{2,}}') AS t FROM parts),
trm AS (SELECT ticket_id, split, unnest(t) AS term FROM tok UNION ALL SELECT ticket_id, split, unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) FROM tok),
tf AS (SELECT ticket_id, split, term, count(*) AS tf FROM trm GROUP BY ALL),
voc0 AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM tf WHERE split = 'train' GROUP BY term HAVING count(*) >= {DEFAULTS.min_df} ORDER BY cf DESC, term LIMIT {max_features}),
voc AS (SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS idx, df, cf, ln((1 + (SELECT count(*) FROM parts WHERE split = 'train')) / (1 + df)) + 1 AS idf FROM voc0),
w0 AS (SELECT tf.ticket_id, tf.split, tf.term, idx, (1 + ln(tf)) * idf AS w FROM tf JOIN voc ON voc.term = tf.term),
w AS (SELECT ticket_id, split, term, idx, w / sqrt(sum(w * w) OVER (PARTITION BY ticket_id)) AS weight FROM w0)"""


def split_corpus(spark, sf):
    return S.stratified_split(stored_corpus(spark, sf))


def fitted(spark, sf, max_features=DEFAULTS.max_features):
    parts = split_corpus(spark, sf)
    return E.fit_tfidf(parts.where(F.col("split") == "train"), "clean_body", max_features=max_features), parts


@query("tfidf_vocab", f"WITH {_tfidf_sql()} SELECT term, idx, df, cf, round(idf, 6) AS idf FROM voc")
def tfidf_vocab(spark, sf):
    return fitted(spark, sf)[0].terms.withColumn("idf", F.round("idf", 6))


@query("tfidf_vocab_capped", f"WITH {_tfidf_sql(1000)} SELECT term, idx, df, cf, round(idf, 6) AS idf FROM voc")
def tfidf_vocab_capped(spark, sf):
    return fitted(spark, sf, 1000)[0].terms.withColumn("idf", F.round("idf", 6))


@query("tfidf_weights", f"WITH {_tfidf_sql()} SELECT ticket_id, term, idx, round(weight, 6) AS weight FROM w WHERE split = 'train'")
def tfidf_weights(spark, sf):
    model, parts = fitted(spark, sf)
    return model.weights(parts.where(F.col("split") == "train")).withColumn("weight", F.round("weight", 6))


@query("tfidf_transform_test", f"WITH {_tfidf_sql()} SELECT ticket_id, term, idx, round(weight, 6) AS weight FROM w WHERE split = 'test'")
def tfidf_transform_test(spark, sf):
    model, parts = fitted(spark, sf)
    return model.weights(parts.where(F.col("split") == "test")).withColumn("weight", F.round("weight", 6))


@query(
    "embed_hashed",
    f"WITH {Q.CASES}, {Q.hashed('v_cases', 64)} SELECT ticket_id, CAST(place AS INTEGER) AS place, round(x, 5) AS x FROM v_cases_cells",
)
def embed_hashed(spark, sf):
    cases = add_clean_columns(views.cases(spark, sf))
    return E.hashed_vectors(cases, "clean_body", 64).select(
        "ticket_id", F.posexplode("embedding").alias("place", "v")
    ).select("ticket_id", "place", F.round(F.col("v").cast("double"), 5).alias("x"))
