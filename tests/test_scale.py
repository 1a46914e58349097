import re

import pytest
from pyspark.sql import functions as F

from ticketloom import scale
from ticketloom.operators import features, overlap


class _Context:
    def __init__(self, master):
        self.master, self.applicationId = master, "app"


class _Session:
    def __init__(self, master, named=None):
        self.sparkContext, self._named = _Context(master), named
        self.conf = self

    def get(self, key, default=None):
        return self._named or default


def test_cluster_names_the_shared_folder():
    assert scale.shared_dir(_Session("spark://host", "hdfs://nn/work/")) == "hdfs://nn/work"
    with pytest.raises(ValueError):
        scale.shared_dir(_Session("spark://host"))


def test_broadcast_only_within_the_bound(spark):
    small, large = spark.range(10), spark.range(11)
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString() or "UnresolvedHint" in df._jdf.queryExecution().logical().toString()
    assert hinted(scale.bounded_broadcast(small, 10))
    assert not hinted(scale.bounded_broadcast(large, 10))


def test_materialized_tables_cut_lineage(spark):
    df = scale.materialize(spark.range(5).selectExpr("id", "id * 2 AS d"), "cut")
    assert sorted(r["d"] for r in df.collect()) == [0, 2, 4, 6, 8]
    assert "Range" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_filters_reach_the_scan(spark, sf):
    from ticketloom.plans import catalog

    plan = catalog.queries()["clean_corpus"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(lang,en)" in plan
    assert plan.count("Generate inline") == 1


def test_tasks_grow_with_the_words(spark, monkeypatch):
    """The session's partition count is fixed; what a task groups must not grow with the table."""
    monkeypatch.setattr(scale, "ROWS_PER_TASK", 50, raising=False)
    docs = spark.range(60).select(F.col("id").alias("ticket_id"), F.lit("alpha beta gamma delta " * 20).alias("text"), F.lit("beta gamma " * 20).alias("other"))
    counts = features.term_counts(docs, "text")
    vocabulary = features.fit_tfidf(docs, "text")
    stored = features.stored_counts(docs, "text")
    plans = {
        "terms": counts, "weights": vocabulary.weights(docs, stored), "hashed": features.hashed_vectors(docs, "text", 8), "bleu": overlap.bleu(docs, "text", "other"),
    }
    for name, df in plans.items():
        dealt = re.findall(r"RepartitionByExpression \[[^\]]*\], (\d+)", df._jdf.queryExecution().optimizedPlan().toString())
        assert dealt and max(map(int, dealt)) > 8, name
    assert counts.count() == 60 * 8 and {r["tf"] for r in counts.where("term = 'delta alpha'").collect()} == {19}
    assert plans["weights"].agg(F.sum(F.col("weight") * F.col("weight"))).first()[0] == pytest.approx(60)
    assert plans["hashed"].count() == plans["bleu"].count() == 60
