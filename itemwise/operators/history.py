"""User histories: parse, explode, de-duplicate, filter, sample.

The working form is long: one row per (user, item). Nothing collects a
user's history into one array, so a user holding a third of all rows is
spread over tasks by item in every step below.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.parse import feature_tokens, token_item, token_pref
from ..functions.sampling import HASH_RANGE, keep_user, user_hash
from ..functions.text import join_labels
from ..session import materialize

# Parts of a range that one round of refinement counts; a power of two that
# divides the hash range evenly at every round.
HISTOGRAM_PARTS = 4096


def explode_history(features: DataFrame, lenient: bool = False,
                    item_as_string: bool = False) -> DataFrame:
    """``(user_id, feature)`` to ``(user_id, pos, item, pref)``, one row per
    token (P1, P2, P4). ``pos`` counts non-empty tokens from 0. Strict mode
    fails on a bad token (Q8); lenient mode drops it."""
    toks = features.select("user_id", F.posexplode(feature_tokens(F.col("feature")))
                           .alias("pos", "tok"))
    out = toks.select("user_id", "pos",
                      token_item(F.col("tok"), lenient, item_as_string).alias("item"),
                      token_pref(F.col("tok"), lenient).alias("pref"))
    if lenient:
        out = out.where(F.col("item").isNotNull() & F.col("pref").isNotNull())
    return out


def last_preference(tokens: DataFrame) -> DataFrame:
    """One row per (user, item); a repeated item keeps the preference of its
    last token (P8). Grouping on (user, item) spreads a heavy user over
    partitions by item, and partial aggregation runs map-side."""
    return (tokens.groupBy("user_id", "item")
            .agg(F.max_by("pref", "pos").alias("pref")))


def interactions_from_features(features: DataFrame, lenient: bool = False) -> DataFrame:
    """Feature table to ``interactions(user_id, item, pref)`` (E5)."""
    return last_preference(explode_history(features, lenient))


def sample_users(interactions: DataFrame, rate: float, seed: str = "") -> DataFrame:
    """Keep the rows of a deterministic hash sample of users (P7). A row
    filter: no shuffle, and it runs before any other work."""
    return interactions.where(keep_user(F.col("user_id"), rate, seed))


def sample_users_exact(interactions: DataFrame, rate: float, seed: str = "",
                       keep: list | None = None) -> DataFrame:
    """Keep the rows of exactly ``floor(users x rate)`` users (P10): those
    with the least hashes, equal hashes by user id. The same users in every
    run and on every partition layout.

    The last hash to keep is found by rounds of histogram refinement over the
    written hashes: each round counts the users of 4096 equal parts of the
    range that is still open and goes on inside the part where the count is
    reached. No global sort; the driver sees at most 4096 counts a round.
    Rows without a user are no user's and go."""
    if not 0 < rate < 1:
        return interactions
    user = F.col("user_id")
    hashes = materialize(interactions.select("user_id").where(user.isNotNull()).distinct()
                         .withColumn("h", user_hash(user, seed)), "user-hashes", keep)
    wanted = math.floor(hashes.count() * rate)
    low, width, below = 0, HASH_RANGE, 0
    while below < wanted and width > 1:
        width //= HISTOGRAM_PARTS
        inside = hashes.where((F.col("h") >= low) & (F.col("h") < low + width * HISTOGRAM_PARTS))
        part = F.expr(f"(h - {low}L) div {width}L").alias("part")
        for r in inside.groupBy(part).count().orderBy("part").collect():
            if below + r["count"] > wanted:
                low += r.part * width
                break
            below += r["count"]
            if below == wanted:
                low += (r.part + 1) * width
                break
    # users of one and the same hash that straddle the count
    ties = [r.user_id for r in hashes.where(F.col("h") == low).orderBy("user_id")
            .limit(wanted - below).collect()] if below < wanted else []
    h = user_hash(user, seed)
    return interactions.where((h < low) | ((h == low) & user.isin(ties)) if ties else h < low)


def sample_feature_rows(features: DataFrame, rate: float, seed: int | None = None) -> DataFrame:
    """Bernoulli sample of feature rows (one row per user), the original
    ``sample(false, rate)`` (P7). Which users are kept depends on the
    partition layout even with a seed (Q3), so the job uses the hash sample
    of ``sample_users``; this is for callers who want the original draw."""
    if not 0 < rate < 1:
        return features
    return features.sample(withReplacement=False, fraction=rate, seed=seed)


def with_history_size(interactions: DataFrame, dedup: bool = True,
                      keep: list | None = None) -> DataFrame:
    """Adds ``k``: the number of distinct items (``dedup``) or of rows of the
    user. The per-user count is a partial aggregation (one row per user and
    map task), written as a table and joined back on ``user_id``: AQE
    broadcasts a small table and splits a skewed user partition otherwise,
    which it cannot do against an aggregate on the join's own key."""
    rows = interactions.select("user_id", "item")
    if dedup:
        rows = rows.dropDuplicates(["user_id", "item"])
    sizes = rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("k"))
    return rows.join(materialize(sizes, "history-sizes", keep), "user_id")


def min_history(interactions: DataFrame, min_items: int = 2, dedup: bool = True,
                keep: list | None = None) -> DataFrame:
    """Rows ``(user_id, item, k)`` of users whose history holds at least
    ``min_items`` items (P5: more than one)."""
    return with_history_size(interactions, dedup, keep).where(F.col("k") >= min_items)


def watched_labels(interactions: DataFrame, labels: DataFrame, sep: str = ",",
                   trailing: bool = False) -> DataFrame:
    """``(user_id, watched)``: the labels of the user's items as a sorted set
    joined by ``sep`` (D2, F6). An item with no label contributes '' (J8).

    Distinct (user, label) pairs come first (partial aggregation, spread by
    label), so the per-user list is bounded by the labels that user has. Give
    ``labels`` as a written table, so that a hot item splits."""
    hist = interactions.select("user_id", F.col("item").cast("bigint").alias("item"))
    named = (hist.join(labels, hist.item == labels.column_index, "left")
             .select("user_id", F.coalesce("label", F.lit("")).alias("label"))
             .distinct())
    return (named.groupBy("user_id")
            .agg(F.sort_array(F.collect_list("label")).alias("labels"))
            .select("user_id", join_labels(F.col("labels"), sep, trailing).alias("watched")))


def unique_user_ids(users: DataFrame) -> DataFrame:
    """``(user_id, uid)``: a unique numeric id per row, with gaps, that
    depends on the partition layout, like the original ``zipWithUniqueId``
    (P9). No shuffle and no driver step; nothing in the job ranks by it."""
    return users.select("user_id", F.monotonically_increasing_id().alias("uid"))
