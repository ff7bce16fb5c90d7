"""Item popularity, co-occurrence and cosine.

Cost model: the pair expansion emits sum_u k_u (k_u - 1) / 2 rows for the
unordered pairs ``i < j``; the ordered table is its mirror. Everything else is
linear in the interactions.

Skew: a user with a very long history would put k_u^2 / 2 pairs into one
task under a plain self-join on the user. Here a history longer than
``block_size`` is cut into ``ceil(k_u / block_size)`` hash blocks of items,
and the self-join runs on ``(user, block_a, block_b)`` with ``block_a <=
block_b``: every unordered pair is produced once, by a task that sees at
most two blocks. Light users are one block and join as before.

That join is only made for pairs with a hot item, whose counts fall together
before the shuffle. All other items are counted by ``pair_counts``, where a pair
is never a row of a shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def item_popularity(base: DataFrame) -> DataFrame:
    """``(item, n)``: rows per item of the filtered, sampled input (A2)."""
    return base.groupBy("item").agg(F.count(F.lit(1)).alias("n"))


def attach_popularity(half: DataFrame, popularity: DataFrame) -> DataFrame:
    """Adds ``ni, nj`` to the counted pairs (J2). Pairs are counted first, so
    the pair stream carries two ids and nothing else; give a written
    ``popularity``, which AQE broadcasts when it is small and whose joins it
    splits when an item is hot."""
    return (half.join(popularity.select(F.col("item").alias("i"), F.col("n").alias("ni")), "i")
            .join(popularity.select(F.col("item").alias("j"), F.col("n").alias("nj")), "j"))


def item_pairs(base: DataFrame, block_size: int, num_partitions: int | None = None) -> DataFrame:
    """Unordered co-occurring pairs ``(i, j)`` with ``i < j``, one row per
    user holding both (J1, P11). ``base`` has ``user_id, item, k``.

    ``num_partitions`` sizes the join's shuffle by the pairs it will emit
    (see ``pair_partitions``); without it AQE sizes it by its input, which
    is tiny next to the pair stream it explodes into. If ``base`` has a column
    ``hot``, only pairs with a hot item are returned."""
    hot = F.col("hot") if "hot" in base.columns else F.lit(True)
    nb = F.greatest(F.lit(1), F.ceil(F.col("k") / F.lit(block_size))).cast("int")
    tagged = base.where(F.col("item").isNotNull()).select("user_id", "item", nb.alias("nb"),
                                                          hot.alias("hot"))
    tagged = tagged.withColumn("b", F.pmod(F.xxhash64("item"), F.col("nb")).cast("int"))
    left = tagged.select("user_id", F.col("item").alias("a"), F.col("b").alias("ba"), F.col("b").alias("k1"),
                         F.col("hot").alias("ha"),
                         F.explode(F.sequence(F.col("b"), F.col("nb") - 1)).alias("k2"))
    right = tagged.select("user_id", F.col("item").alias("c"), F.col("b").alias("bc"), F.col("b").alias("k2"),
                          F.col("hot").alias("hc"),
                          F.explode(F.sequence(F.lit(0), F.col("b"))).alias("k1"))
    # Shuffle on the whole key, so a heavy user's block pairs land in many
    # tasks even if the input is already partitioned by user_id alone.
    keys = ["user_id", "k1", "k2"]
    if num_partitions:
        left, right = left.repartition(num_partitions, *keys), right.repartition(num_partitions, *keys)
    else:
        left, right = left.repartition(*keys), right.repartition(*keys)
    pairs = (left.join(right, keys)
             .where((F.col("ha") | F.col("hc"))
                    & ((F.col("ba") < F.col("bc")) | (F.col("a") < F.col("c")))))
    return pairs.select(F.least("a", "c").alias("i"), F.greatest("a", "c").alias("j"))


# Fixed value: pair rows per task of the pair join.
PAIRS_PER_TASK = 4_000_000


def pair_partitions(user_rows: DataFrame, min_items: int = 2) -> int:
    """Partitions for the pair join: sum over users of k (k - 1) / 2, from a
    per-user row count (partial aggregation; only a users-sized shuffle),
    divided by ``PAIRS_PER_TASK``, at least the cluster's parallelism. Runs a
    small job, so give written rows.
    Duplicate rows only make the estimate larger."""
    sizes = user_rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("k"))
    pairs = (sizes.where(F.col("k") >= min_items)
             .agg(F.sum(F.col("k") * (F.col("k") - 1) / 2).alias("p")).first().p) or 0
    parallelism = user_rows.sparkSession.sparkContext.defaultParallelism
    return max(parallelism, math.ceil(pairs / PAIRS_PER_TASK))


def cooccurrence_half(base: DataFrame, block_size: int,
                      num_partitions: int | None = None) -> DataFrame:
    """``(i, j, c)`` for ``i < j``: users holding both items (A1).
    Partial aggregation combines pairs map-side before the shuffle."""
    return (item_pairs(base, block_size, num_partitions)
            .groupBy("i", "j")
            .agg(F.count(F.lit(1)).alias("c")))


def cosine_weight() -> F.Column:
    """``c / sqrt(n_i * n_j)`` with the product taken in double, so it cannot
    overflow (F1, Q2)."""
    return F.col("c") / F.sqrt(F.col("ni").cast("double") * F.col("nj"))


def mirror(half: DataFrame, value_cols: list[str]) -> DataFrame:
    """Both orientations of each ``i < j`` row, in one pass (no union, so the
    input is computed once). Exact because ``c`` and the cosine are symmetric."""
    flip = F.col("flip")
    both = half.select("i", "j", *value_cols,
                       F.explode(F.array(F.lit(False), F.lit(True))).alias("flip"))
    return both.select(F.when(flip, F.col("j")).otherwise(F.col("i")).alias("i"),
                       F.when(flip, F.col("i")).otherwise(F.col("j")).alias("j"), *value_cols)


def positive_cosine(half: DataFrame) -> DataFrame:
    """``(i, j, sim)`` for ``i < j`` from the half co-occurrence table; pairs
    whose count or popularity product is not positive are dropped (P12)."""
    keep = (F.col("ni").cast("double") * F.col("nj") > 0) & (F.col("c") > 0)
    return half.where(keep).select("i", "j", cosine_weight().alias("sim"))


def popularity_summary(popularity: DataFrame, max_index: DataFrame) -> DataFrame:
    """Summary of the popularity array of the original job (A3): its length
    ``max_index + 1``, the largest count, and how many ids in ``0..max_index``
    no user has. ``max_index`` is a one-row frame (A4) used as a scalar
    subquery; the id range is never enumerated."""
    m = max_index.select(F.col("max_index").cast("bigint")).scalar()
    in_range = (F.col("item") >= 0) & (F.col("item") <= m)
    return popularity.agg(
        (m + 1).alias("n_length"),
        F.max("n").alias("n_max"),
        (m + 1 - F.count_if(in_range)).alias("n_zero"))


def similarity_summary(similarity: DataFrame) -> DataFrame:
    """Size of the similarity table (A8, re-aimed from a heap estimate):
    items with a list, entries, and the mean list length."""
    return similarity.agg(
        F.countDistinct("i").alias("items"),
        F.count(F.lit(1)).alias("entries"),
        (F.count(F.lit(1)) / F.countDistinct("i")).alias("avg_list_len"))
