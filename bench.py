"""Headline queries, timed: prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from check import session
from ticketloom.plans import catalog

HEADLINE = [
    "clean_corpus", "duplicate_bodies", "label_conflicts", "length_describe", "length_histogram",
    "top_keywords_per_queue", "queue_tag_crosstab", "stratified_split", "tfidf_weights", "knn_topk",
    "knn_vote_eval", "retrieval_at_k", "classification_report", "parse_responses", "bleu_pairs",
    "rouge_l_pairs", "triage_records", "train_text_logreg", "rag_eval_summary", "stream_triage",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    queries = catalog.queries()
    # Start the JVM's compiler and the Python workers on a query that is not timed.
    queries["retrieved_payload"](spark, sf).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        start = time.time()
        queries[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times, "sf": sf.rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
