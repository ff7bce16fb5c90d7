"""DataFrame operators of item-based collaborative filtering."""

from .cooccurrence import (cooccurrence_half, item_pairs, item_popularity, mirror,
                           popularity_summary, positive_cosine, similarity_summary,
                           attach_popularity)
from .history import (explode_history, interactions_from_features, last_preference,
                      min_history, sample_feature_rows, sample_users, sample_users_exact,
                      unique_user_ids, watched_labels, with_history_size)
from .item_vectors import dense_user_ids, item_vectors, vector_overlap, vector_popularity
from .recommend import (attach_labels, candidates, drop_watched, reach, score_candidate_side,
                        score_source_side, unseen_candidates)
from .topn import nested_lists, normalize_rows, preview, top_per_group, top_similar
from .vector_pruning import PrunedSearch, vector_topk_pruned
from .vector_search import vector_topk

__all__ = [
    "attach_labels", "candidates", "cooccurrence_half", "drop_watched", "explode_history",
    "interactions_from_features", "item_pairs", "item_popularity", "last_preference",
    "min_history", "mirror", "nested_lists", "normalize_rows", "popularity_summary",
    "positive_cosine", "preview", "reach", "sample_feature_rows", "sample_users", "score_candidate_side",
    "score_source_side", "similarity_summary", "top_per_group", "top_similar",
    "PrunedSearch", "dense_user_ids", "item_vectors", "sample_users_exact", "vector_overlap",
    "vector_popularity", "vector_topk_pruned",
    "unique_user_ids", "unseen_candidates", "vector_topk", "watched_labels", "with_history_size", "attach_popularity",
]
