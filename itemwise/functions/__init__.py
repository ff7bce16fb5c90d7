"""Column-level helpers, all built from ``pyspark.sql.functions``."""

from .dates import day_before, yesterday
from .parse import feature_item_ids, feature_tokens, parse_feature, token_item, token_pref
from .sampling import keep_user, user_hash
from .text import format_score, join_labels, join_scored
from .vectors import cosine, dot, norm, unit

__all__ = [
    "cosine", "day_before", "dot", "feature_item_ids", "feature_tokens", "format_score",
    "join_labels", "join_scored", "keep_user", "norm", "parse_feature", "token_item",
    "token_pref", "unit", "user_hash", "yesterday",
]
