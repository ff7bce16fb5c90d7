"""Item vectors over users as bitmaps.

The dense vector of an item has one place per user. Here users are numbered
densely in the order of their ids, the numbers are cut into ranges of at most
``RANGE_USERS``, and a row ``(item, user_range)`` holds one bitmap of its
range. A vector is never gathered whole: a hot item is many rows of at most
4 KB, an item that no user of a range has is no row there. Places are shuffled,
not bitmaps: the built-in aggregates hold 4 KB a bitmap, however few users it
has, so it is built where it stays and cut to the length of its range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

# Fixed value: the bits of one bitmap of the built-in bitmap aggregates.
RANGE_USERS = 32768
_LOW_BITS = 33      # monotonically_increasing_id: row in its partition


def dense_user_ids(users: DataFrame, keep: list | None = None) -> DataFrame:
    """``(user_id, uid)``: 0, 1, ... in the order of distinct ``user_id``.
    Users are sorted into ranges, numbered in their range, and shifted by the
    sizes of the ranges before; the same numbers on every partition layout."""
    ids = users.select("user_id").distinct()
    rows = materialize(ids.repartitionByRange("user_id").sortWithinPartitions("user_id")
                       .withColumn("local", F.monotonically_increasing_id()), "user-order", keep)
    part = F.shiftright("local", _LOW_BITS)
    sizes = rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    # one row per range of the sort
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return (rows.withColumn("part", part).join(starts, "part")
            .select("user_id", (F.col("start") + F.col("local").bitwiseAND((1 << _LOW_BITS) - 1))
                    .alias("uid")))


def item_vectors(interactions: DataFrame, user_ids: DataFrame,
                 range_users: int = RANGE_USERS) -> DataFrame:
    """``(item, user_range, bits, users)``: bit ``uid % range_users`` is set
    when the item stands in that user's history; repeated rows count once.
    Give written tables, so that the join on a hot user splits."""
    if not 0 < range_users <= RANGE_USERS:
        raise ValueError(f"range_users must lie in 1..{RANGE_USERS}")
    placed = interactions.select("user_id", "item").join(user_ids, "user_id").select(
        "item", F.expr(f"uid div {range_users}").alias("user_range"),
        (F.col("uid") % range_users).alias("place"))
    length = -(-range_users // 8)
    return (placed.repartition("item", "user_range").groupBy("item", "user_range")
            .agg(F.bitmap_construct_agg("place").alias("bits"))
            .withColumn("users", F.bitmap_count("bits"))
            .select("item", "user_range", F.substring("bits", 1, length).alias("bits"), "users"))


def vector_popularity(vectors: DataFrame) -> DataFrame:
    """``(item, n)``: users of an item, from its bitmaps; equals A2 on
    distinct interactions."""
    return vectors.groupBy("item").agg(F.sum("users").alias("n"))


def vector_overlap(vectors: DataFrame, pairs: DataFrame) -> DataFrame:
    """``(i, j, c)``: users that hold both items, for given pairs: per range
    |A| + |B| - |A or B|, so a pair costs as many rows as it has ranges."""
    i = vectors.select(F.col("item").alias("i"), "user_range", F.col("bits").alias("bi"),
                       F.col("users").alias("ui"))
    j = vectors.select(F.col("item").alias("j"), "user_range", F.col("bits").alias("bj"),
                       F.col("users").alias("uj"))
    both = pairs.select("i", "j").distinct().join(i, "i").join(j, ["j", "user_range"])
    sides = both.select("i", "j", "user_range", (F.col("ui") + F.col("uj")).alias("n"),
                        F.explode(F.array("bi", "bj")).alias("bits"))
    ranges = sides.groupBy("i", "j", "user_range").agg(
        F.first("n").alias("n"), F.bitmap_count(F.bitmap_or_agg("bits")).alias("either"))
    return ranges.groupBy("i", "j").agg(F.sum(F.col("n") - F.col("either")).alias("c")).where(
        "c > 0")
