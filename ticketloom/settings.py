"""Job parameters, with the defaults the operators fall back on."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class JobSettings:
    language: str = "en"
    min_body_chars: int = 30
    max_body_chars: int = 5000
    max_request_chars: int = 5000
    top_k: int = 5
    rerank_keep: int = 5
    confidence_threshold: float = 0.55
    eval_sample_size: int = 250
    seed: int = 42
    embedding_dim: int = 384
    token_limit: int = 512
    max_features: int = 50_000
    min_df: int = 2


DEFAULTS = JobSettings()
