"""Readers: the daily feature and dictionary tables (S1-S3), and the same
data model derived from the driver's test tables."""

from .fixtures import (basket_features, basket_interactions, embeddings, order_features,
                       order_interactions, part_dictionary, table)
from .tables import dictionary_labels, max_item_id, read_dictionary, read_features

__all__ = [
    "basket_features", "basket_interactions", "dictionary_labels", "embeddings", "max_item_id",
    "order_features", "order_interactions", "part_dictionary", "read_dictionary",
    "read_features", "table",
]
