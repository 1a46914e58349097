"""All named queries and the SQL they are checked against."""

from __future__ import annotations

from ticketloom.plans import corpus_queries, feature_queries, model_queries, profile_queries, retrieval_queries, stream_queries, triage_queries  # noqa: F401
from ticketloom.plans.registry import ORACLES, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)
