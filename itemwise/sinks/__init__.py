"""Sinks: output layouts (K4-K7) and the daily partition write (K1-K3)."""

from .layouts import LAYOUT_COLUMNS, scored_list, source_recom, user_watched
from .tables import (ensure_table, overwrite_partition, partition_location, publish_partition,
                     stage_partition)

__all__ = ["LAYOUT_COLUMNS", "ensure_table", "overwrite_partition", "partition_location",
           "publish_partition", "scored_list", "source_recom", "stage_partition", "user_watched"]
