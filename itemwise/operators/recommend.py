"""Candidates, scores and labels.

Inputs are long: ``hist(user_id, item, pref)`` with one row per (user,
item), and ``sim(i, j, sim)`` holding the cut similarity lists. Every join
is an equi-join on an item or (user, item) key, so Spark hash-partitions
the work. AQE splits a hot key only where both sides of a join are plain
shuffles, so what is aggregated on a join's own key is written as a table
before it is joined.

A user's candidates are many times the user's items, so they are no rows of a
shuffle: a row of ``hist`` meets its item's list as arrays, goes to its user, and
is only there taken apart, made distinct and summed. Shuffles by user are sized by
the rows they are taken apart into. A user with more of them than a task is to
hold is heavy and is dealt over tasks by candidate.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .packed import CANDIDATE, SEEN, TERM, summed_by_users

# Entries that a task takes the lists of its users apart into, rows
# of ``hist`` per group of users when heavy users are looked for, and entries up to
# which lists are shuffled as they are, where packing them is not worth its start.
TASK_TERMS = 4_000_000
GROUP_ROWS = 1_000
PLAIN_TERMS = 8_000_000
PLAIN_TASK_TERMS = 1_000_000
# Rows per core that candidates with the wide entries of their lists
# make at once, and rows of them that a task sorts.
PASS_TERMS = 8_000_000
TASK_ROWS = 1_000_000


def reach(hist: DataFrame, sim: DataFrame) -> DataFrame:
    """``(user_id, item, w)``: every item in the list of an item the user has,
    with ``w = pref * sim`` from the source item's list (J3)."""
    lists = sim.select(F.col("i").alias("src"), F.col("j").alias("item"), "sim")
    return (hist.select("user_id", F.col("item").alias("src"), "pref")
            .join(lists, "src")
            .select("user_id", "item", (F.col("pref") * F.col("sim")).alias("w")))


def _entries(sim: DataFrame, kind: int, key: str = "i", item: str = "j") -> DataFrame:
    """``sim`` as ``(src, item, sim, kind)``: what a user with ``src`` gets."""
    return sim.select(F.col(key).alias("src"), F.col(item).alias("item"), "sim",
                      F.lit(kind).cast("tinyint").alias("kind"))


def _bare(sim: DataFrame) -> DataFrame:
    """``sim`` for entries that are no terms."""
    return sim.withColumn("sim", F.lit(None).cast("double"))


def _self_entries(sim: DataFrame) -> DataFrame:
    """Items of the lists, on either side, as entries of themselves."""
    items = sim.select(F.explode(F.array("i", "j")).alias("i")).distinct()
    return _entries(_bare(items), SEEN, "i", "i")


def _heavy_users(hist: DataFrame, rows: int, limit: int, keep: list | None) -> DataFrame | None:
    """``(user_id, parts)`` of users with more than ``limit`` rows, None if
    there are none. Users are counted in groups first, and one by one only in
    groups that exceed the limit."""
    groups = F.pmod(F.xxhash64("user_id"), F.lit(max(1, rows // GROUP_ROWS))).alias("g")
    users = hist.select("user_id", groups)
    full = users.groupBy("g").count().where(F.col("count") > limit).select("g")
    if full.isEmpty():
        return None
    heavy = materialize(users.join(full, "g").groupBy("user_id").count()
                        .where(F.col("count") > limit)
                        .select("user_id", F.ceil(F.col("count") / limit).cast("int")
                                .alias("parts")), "heavy-users", keep)
    return None if heavy.isEmpty() else heavy


def _item_lists(entries: DataFrame, keep: list | None) -> DataFrame:
    """``(src, items, sims, kinds)``, written: the entries of an item as arrays,
    sorted by item, so that neighbouring ids differ by little."""
    return materialize(
        entries.groupBy("src")
        .agg(F.sort_array(F.collect_list(F.struct("item", "sim", "kind"))).alias("l"))
        .select("src", F.col("l.item").alias("items"), F.col("l.sim").alias("sims"),
                F.col("l.kind").alias("kinds")), "item-lists", keep)


def _user_items(hist: DataFrame, lists: DataFrame, terms: DataFrame | None = None,
                keep: list | None = None,
                best: tuple[int, int, bool] | None = None) -> DataFrame:
    """``(user_id, item, total)``: candidates in the ``lists`` of the user's items,
    without items that the user has; ``total`` is the sum of ``pref * sim`` of all
    entries of the item and of ``w`` of ``terms(user_id, item, w)``. With ``best``
    those that cannot be among a user's best may be left out (``packed``).

    All of a user's rows go to one task, unless some user is heavy."""
    load = (hist.groupBy(F.col("item").alias("src")).agg(F.count(F.lit(1)).alias("n"))
            .join(lists.select("src", F.size("items").alias("size")), "src")
            .agg(F.sum("n").alias("rows"), F.sum(F.col("n") * F.col("size")).alias("entries"))
            .first())
    rows, mean = load.rows or 0, (load.entries / load.rows if load.rows else 1.0)
    many = load.rows and load.entries > PLAIN_TERMS
    limit = TASK_TERMS if many else min(TASK_TERMS, PLAIN_TASK_TERMS)
    tasks = max(hist.sparkSession.sparkContext.defaultParallelism,
                math.ceil(rows * mean / limit))
    nested = (hist.select("user_id", F.col("item").alias("src"), F.col("pref").cast("double"))
              .join(lists, "src").select("user_id", "pref", "items", "sims", "kinds"))
    if terms is not None:
        nested = nested.unionByName(terms.select(
            "user_id", F.lit(1.0).alias("pref"), F.array("item").alias("items"),
            F.array("w").alias("sims"), F.array(F.lit(TERM).cast("tinyint")).alias("kinds")))
    heavy = _heavy_users(hist, rows, max(1, int(limit / mean)), keep)
    keys = ["user_id"]
    if heavy is not None:
        # entries of heavy users are dealt by their item, one list of one each
        keys = ["user_id", "part"]
        own = ["user_id", "pref", "items", "sims", "kinds"]
        one = F.explode(F.arrays_zip("items", "sims", "kinds"))
        part = F.pmod(F.xxhash64("e.items"), F.col("parts")).cast("int")
        heavy = heavy.withColumnRenamed("user_id", "_user")
        is_user = F.col("user_id").eqNullSafe(F.col("_user"))
        marked = nested.join(heavy, is_user, "left")
        light = marked.where(F.col("parts").isNull()).select(*own, F.lit(0).alias("part"))
        nested = light.unionByName(
            nested.join(heavy, is_user).select("user_id", "pref", "parts", one.alias("e"))
            .select("user_id", "pref", F.array("e.items").alias("items"),
                    F.array("e.sims").alias("sims"), F.array("e.kinds").alias("kinds"),
                    part.alias("part")))
    if many:
        return summed_by_users(nested, tasks, keys, best)
    entry = F.explode(F.arrays_zip("items", "sims", "kinds")).alias("e")
    return (nested.repartition(tasks, *keys).select(*keys, "pref", entry)
            .select(*keys, F.col("e.items").alias("item"),
                    (F.col("pref") * F.col("e.sims")).alias("w"), F.col("e.kinds").alias("kind"))
            .groupBy(*keys, "item")
            .agg(F.sum("w").alias("total"), _kind(CANDIDATE).alias("is_cand"),
                 _kind(SEEN).alias("seen"))
            .where(_WANTED).select("user_id", "item", "total"))


# candidates the user does not have; rows without a user are nobody's
_WANTED = "is_cand and not (seen and user_id is not null)"


def _kind(kind: int) -> F.Column:
    return F.max(F.col("kind") == kind)


def candidates(hist: DataFrame, sim: DataFrame, keep: list | None = None) -> DataFrame:
    """Distinct ``(user_id, item)`` reachable through the lists."""
    lists = _item_lists(_entries(_bare(sim), CANDIDATE), keep)
    return _user_items(hist, lists, keep=keep).select("user_id", "item")


def unseen_candidates(hist: DataFrame, sim: DataFrame, keep: list | None = None) -> DataFrame:
    """``candidates`` without the items that the user has."""
    lists = _item_lists(_entries(_bare(sim), CANDIDATE).unionByName(_self_entries(sim)), keep)
    return _user_items(hist, lists, keep=keep).select("user_id", "item")


def drop_watched(df: DataFrame, hist: DataFrame) -> DataFrame:
    """Remove (user, item) pairs the user already has."""
    return df.join(hist.select("user_id", "item"), ["user_id", "item"], "left_anti")


def _wide_terms(hist: DataFrame, sim: DataFrame, wide: DataFrame,
                keep: list | None) -> DataFrame:
    """``(user_id, item, w)``, written: the terms of unseen candidates from the
    entries ``wide(i, j, sim)`` of the candidates' own lists, summed.

    A candidate meets all wide entries of its list, though few of their items are
    the user's. So as many users are taken at once as make ``PASS_TERMS`` such rows
    per core, and what they shuffled is deleted before the next ones."""
    sizes = wide.groupBy(F.col("i").alias("j")).agg(F.count(F.lit(1)).alias("size"))
    # candidates whose own list holds an item of many lists
    to_wide = sim.join(wide.select(F.col("i").alias("j")), "j", "left_semi")
    made = (to_wide.join(sizes, "j").groupBy(F.col("i").alias("item"))
            .agg(F.sum("size").alias("size")))
    total = (hist.groupBy("item").agg(F.count(F.lit(1)).alias("n")).join(made, "item")
             .agg(F.sum(F.col("n") * F.col("size")).alias("rows")).first().rows) or 0
    parts = max(1, math.ceil(total / (
        PASS_TERMS * hist.sparkSession.sparkContext.defaultParallelism)))
    lists = _item_lists(_entries(_bare(to_wide), CANDIDATE).unionByName(_self_entries(to_wide)),
                        keep)
    entries = wide.select(F.col("i").alias("item"), F.col("j").alias("m"), "sim")
    # the join by user and item is sized by the rows that it sorts
    tasks = max(1, math.ceil(total / parts / TASK_ROWS))
    terms = None
    for part in range(parts):
        some = hist.where(F.pmod(F.hash("user_id"), F.lit(parts)) == part)
        watched = some.select("user_id", F.col("item").alias("m"), "pref")
        found = materialize(
            _user_items(some, lists, keep=keep).select("user_id", "item").join(entries, "item")
            .repartition(tasks, "user_id", "m")
            .join(watched.repartition(tasks, "user_id", "m"), ["user_id", "m"])
            .groupBy("user_id", "item")
            .agg(F.sum(F.col("pref") * F.col("sim")).alias("w")), "wide-terms", keep)
        terms = found if terms is None else terms.unionByName(found)
    return terms


def score_candidate_side(hist: DataFrame, sim: DataFrame, decimals: int = 6,
                         reverse_limit: int = 100, keep: list | None = None,
                         among: DataFrame | None = None, best: int | None = None) -> DataFrame:
    """``(user_id, item, score)`` for every unseen candidate: the sum of
    ``pref * sim`` over the user's items found in the **candidate's own**
    list (J5, A7). A candidate whose list holds none of them scores 0.0 and
    stays (Q7). With ``among(column_index)`` only these items are candidates;
    with ``best`` those that are not among a user's ``best`` highest may be left out.

    Each term (user u, candidate c, watched item m in the list of c) is found
    by exactly one of two joins, chosen by how many lists contain m:

    * at most ``reverse_limit`` lists: u's row for m gets those lists beside
      m's own (``hist x lists on m``); rows <= reverse_limit x interactions, and
      about N x interactions on average;
    * more lists (m is in many lists): join each candidate with the entries
      of its own list that are such items, then with u's row for m; rows <=
      candidates x N.

    So the work stays linear in the interactions even for an item that sits
    in every list, and no candidate is capped or dropped.
    """
    in_lists = materialize(sim.groupBy("j").agg(F.count(F.lit(1)).alias("r")), "list-counts", keep)
    hot = in_lists.where(F.col("r") > reverse_limit).select("j")
    short, terms = sim, None
    if not hot.isEmpty():
        short = sim.join(hot, "j", "left_anti")
        wide = materialize(sim.select("i", "j", "sim").join(hot, "j", "left_semi"),
                           "reverse-lists", keep)
        terms = _wide_terms(hist, sim, wide, keep)
    # One shuffle makes candidates distinct, drops watched ones and sums the
    # terms; a candidate with no term scores 0.0, and terms of items that are
    # not reached fall away.
    entries = (_entries(_bare(_among(sim, among)), CANDIDATE)
               .unionByName(_entries(short, TERM, "j", "i")).unionByName(_self_entries(sim)))
    lists = _item_lists(entries, keep)
    return _user_items(hist, lists, terms, keep, best and (best, decimals, False)).select(
        "user_id", "item", F.round(F.coalesce("total", F.lit(0.0)), decimals).alias("score"))


def score_source_side(hist: DataFrame, sim: DataFrame, decimals: int = 6,
                      keep: list | None = None, among: DataFrame | None = None,
                      best: int | None = None) -> DataFrame:
    """``(user_id, item, score)``: the sum of ``pref * sim`` over the user's
    items whose **own** list holds the candidate (J6, A7). Candidates, scores
    and watched items come from the same join and aggregation. With
    ``among(column_index)`` only these items are candidates; with ``best`` those
    that are not among a user's ``best`` highest may be left out."""
    entries = _entries(_among(sim, among), CANDIDATE).unionByName(_self_entries(sim))
    lists = _item_lists(entries, keep)
    return _user_items(hist, lists, keep=keep, best=best and (best, decimals, True)).select(
        "user_id", "item", F.round("total", decimals).alias("score"))


def _among(sim: DataFrame, items: DataFrame | None) -> DataFrame:
    """Entries whose item is one of ``items(column_index)``, all by default."""
    if items is None:
        return sim
    ids = items.select(F.col("column_index").alias("_id"))
    return sim.join(ids, F.col("j").cast("bigint") == F.col("_id"), "left_semi")


def attach_labels(df: DataFrame, labels: DataFrame, missing: str = "drop") -> DataFrame:
    """Adds ``label`` from ``labels(column_index, label)``; give a written
    table, so that a hot item splits.

    ``drop``: rows with no label are removed (J7); ``empty``: they get ''
    (J8); ``error``: the job fails (J9)."""
    lab = labels.select(F.col("column_index").alias("_id"), "label")
    how = "inner" if missing == "drop" else "left"
    out = df.join(lab, df.item.cast("bigint") == lab._id, how).drop("_id")
    if missing == "empty":
        out = out.withColumn("label", F.coalesce("label", F.lit("")))
    elif missing == "error":
        out = out.withColumn("label", F.when(F.col("label").isNull(), F.raise_error(
            F.concat(F.lit("item without label: "), F.col("item").cast("string"))))
            .otherwise(F.col("label")))
    return out
