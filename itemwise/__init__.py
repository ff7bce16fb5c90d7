"""itemwise: item-to-item collaborative filtering on Spark DataFrames.

Interactions ``(user_id, item, pref)`` -> item co-occurrence cosine with a
top-N cut and optional row-max normalisation -> top-K unseen items per user,
scored from the candidate's or the source item's list -> a daily table
partition. Also exact top-K cosine search over array columns.
"""

from .config import RecConfig
from .operators.vector_search import vector_topk
from .plans import (build_output, cooccurrence, cosine_similarity, item_similarity, recommend,
                    run_recommendations, vector_job_config)

__all__ = ["RecConfig", "build_output", "cooccurrence", "cosine_similarity", "item_similarity",
           "recommend", "run_recommendations", "vector_job_config", "vector_topk"]
