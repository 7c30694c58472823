"""All queries of the package, by name."""

from __future__ import annotations

from . import (  # noqa: F401  (each registers its queries)
    q_centroids, q_chat, q_classifiers, q_cws, q_exact_dedup, q_mixing, q_periodic_runs, q_quality, q_simhash, q_suffix_dedup, q_tokens)
from .registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
