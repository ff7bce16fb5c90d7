"""Composed plans: similarity (E1), recommendation (E2, E3), the daily job
(E5-E7), and the catalog of registered queries with their SQL oracles."""

from .jobs import build_output, run_recommendations, vector_job_config
from .recommend import recommend, scores
from .similarity import cooccurrence, cosine_similarity, item_similarity, similarity_base

__all__ = ["build_output", "cooccurrence", "cosine_similarity", "item_similarity", "recommend",
           "run_recommendations", "scores", "similarity_base", "vector_job_config"]
