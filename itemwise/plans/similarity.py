"""Item similarity lists from interactions.

Plan shape (no driver collect; history sizes, the filtered rows and the
popularity are written tables, see ``materialize``):

    interactions -> hash sample of users (row filter, P7)
      -> distinct (user, item) + history size k (partial agg, join; P5)
      -> popularity n and number of pairs of each item (A2)
      -> histories sent to the buckets of their items, which count whole items
         (J1, A1), divide by sqrt(n_i n_j) (J2, F1) and cut to the best N
      -> pairs with a hot item: block-salted self-join on the user, i < j only,
         count per pair map-side, popularity joined, both orientations (mirror)
      -> row_number() <= N per item, WindowGroupLimit (T1) -> row max (T5)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import RecConfig
from ..operators import pair_counts
from ..operators.cooccurrence import (attach_popularity, cooccurrence_half, mirror,
                                      pair_partitions, positive_cosine)
from ..operators.history import min_history, sample_users, sample_users_exact
from ..operators.pair_counts import item_weights
from ..operators.topn import normalize_rows, top_similar
from ..session import materialize


def filtered_interactions(interactions: DataFrame, cfg: RecConfig = RecConfig(),
                          keep: list | None = None) -> DataFrame:
    """``(user_id, item, k)``: sampled users (P7, P10) with a long enough history
    (P5). Popularity and co-occurrence both count exactly these rows."""
    sampled = (sample_users_exact(interactions, cfg.sample_rate, cfg.sample_seed, keep)
               if cfg.sample_exact
               else sample_users(interactions, cfg.sample_rate, cfg.sample_seed))
    return min_history(sampled, cfg.min_items, cfg.dedup, keep)


def similarity_base(interactions: DataFrame, cfg: RecConfig = RecConfig(),
                    keep: list | None = None) -> DataFrame:
    """The filtered rows as a written table: popularity, the pair sizes and
    the pair join read it."""
    return materialize(filtered_interactions(interactions, cfg, keep), "base", keep)


def _weights(base: DataFrame, keep: list | None) -> DataFrame:
    return materialize(item_weights(base), "popularity", keep)


def _is_hot(base: DataFrame) -> F.Column:
    """Items whose pairs are too many for a step of the buckets, and all items
    that are no integers."""
    if not isinstance(base.schema["item"].dataType, T.IntegralType):
        return F.lit(True)
    return F.col("pairs") > pair_counts.STEP_PAIRS


def _hot_half(base: DataFrame, hot: DataFrame, cfg: RecConfig) -> DataFrame:
    """The ``i < j`` co-occurrence table of pairs with a hot item, from the
    users that have one. The pair join is sized by the pairs that these rows
    emit (a small job over per-user counts)."""
    rows = base.join(hot.withColumn("hot", F.lit(True)), "item", "left").select(
        "user_id", "item", "k", F.col("hot").isNotNull().alias("hot"))
    rows = rows.join(rows.where("hot").select("user_id"), "user_id", "left_semi")
    return cooccurrence_half(rows, cfg.block_size, pair_partitions(rows, cfg.min_items))


def cooccurrence(interactions: DataFrame, cfg: RecConfig = RecConfig(),
                 keep: list | None = None) -> DataFrame:
    """``(i, j, c)`` for every ordered pair of distinct co-occurring items (A1)."""
    base = similarity_base(interactions, cfg, keep)
    weights = _weights(base, keep)
    hot = weights.where(_is_hot(base)).select("item")
    pairs = mirror(_hot_half(base, hot, cfg), ["c"]).join(
        hot.select(F.col("item").alias("i")), "i", "left_semi")
    return _with_buckets(pairs, base, weights, cfg, "c")


def cosine_similarity(interactions: DataFrame, cfg: RecConfig = RecConfig(),
                      keep: list | None = None, best: int | None = None) -> DataFrame:
    """``(i, j, sim)`` for every ordered pair (F1), uncut; with ``best`` an item's
    pairs that are not among its ``best`` most similar may be left out."""
    base = similarity_base(interactions, cfg, keep)
    weights = _weights(base, keep)
    hot = weights.where(_is_hot(base)).select("item")
    half = attach_popularity(_hot_half(base, hot, cfg), weights)
    pairs = mirror(positive_cosine(half), ["sim"]).join(
        hot.select(F.col("item").alias("i")), "i", "left_semi")
    return _with_buckets(pairs, base, weights, cfg, "sim", best)


def _with_buckets(hot_pairs: DataFrame, base: DataFrame, weights: DataFrame, cfg: RecConfig,
                  value: str, best: int | None = None) -> DataFrame:
    if not isinstance(base.schema["item"].dataType, T.IntegralType):
        return hot_pairs
    return hot_pairs.unionByName(pair_counts.bucket_pairs(base, weights, cfg.block_size, value,
                                                          best))


def item_similarity(interactions: DataFrame, cfg: RecConfig = RecConfig(),
                    keep: list | None = None) -> DataFrame:
    """``(i, j, sim, rk)``: the N most similar items of each item, optionally
    divided by the row maximum (E1)."""
    top = top_similar(cosine_similarity(interactions, cfg, keep, best=cfg.top_n), cfg.top_n)
    if cfg.normalize:
        top = normalize_rows(top)
    return top.select("i", "j", "sim", "rk")
