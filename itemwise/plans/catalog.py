"""Registered queries over the driver's test tables, and their SQL oracles.

Every query reads whole tables (``orders``, ``lineitem``, ``part``,
``embeddings``) through the derivations in ``itemwise.sources.fixtures``;
the matching SQL rebuilds the same inputs with plain joins and GROUP BYs and
computes the result the naive way (full self-join, no blocks, no mirror), so
it checks the Spark plan rather than repeating it.

Column names and types agree on both sides: ids ``int``/``bigint``, counts
``bigint``, scores ``double`` rounded to 6 decimals, ranks ``int``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import RecConfig
from ..functions.dates import day_before
from ..functions.sampling import HASH_HEX_DIGITS, HASH_RANGE
from ..functions.vectors import cosine
from ..operators.cooccurrence import item_popularity, popularity_summary, similarity_summary
from ..operators.history import (explode_history, last_preference, min_history, sample_users,
                                 sample_users_exact, unique_user_ids, watched_labels)
from ..operators.item_vectors import (dense_user_ids, item_vectors, vector_overlap,
                                      vector_popularity)
from ..operators.recommend import (candidates, score_candidate_side, score_source_side,
                                   unseen_candidates)
from ..operators.topn import nested_lists, preview, top_per_group
from ..operators.vector_pruning import vector_topk_pruned
from ..operators.vector_search import vector_topk
from ..session import ensure_checkpoint_dir, materialize
from ..sinks.layouts import LAYOUT_COLUMNS, scored_list, source_recom, user_watched
from ..sinks.tables import ensure_table, overwrite_partition
from ..sources import fixtures as fx
from ..sources.tables import dictionary_labels, max_item_id
from .jobs import run_recommendations, vector_job_config
from .recommend import recommend
from .similarity import cooccurrence, cosine_similarity, filtered_interactions, item_similarity

# Parameters of the registered queries (fixed values).
SAMPLE_RATE = 0.3          # P7 query
TOP_N = 10                 # similar items per item
TOP_K = 10                 # recommendations per user
PREVIEW_ROWS = 100         # T6, as in the preview job
PREVIEW_LISTS = 10         # T6, similarity lists shown
COPY_SHIFT = 1_000_000_000  # added to the ids of copied vectors
VECTOR_K = 10              # neighbours per vector
VECTOR_BLOCK = 128         # rows of a block in the query of the pruned search
RANGE = 2048               # users of one bitmap in the item-vector queries
DAYS = (20231231, 20240101)  # partitions written by the sink query

PROD = RecConfig(top_n=TOP_N, top_k=TOP_K, normalize=True, scoring="candidate")
RAW = RecConfig(top_n=TOP_N, top_k=TOP_K, normalize=False)
VECTOR_JOB = RecConfig(top_n=10, top_k=10, normalize=False, scoring="source",
                       missing_label="error", layout="scored_list")


# ---------------------------------------------------------------- Spark side

def _hist(spark, sf):
    return fx.order_interactions(spark, sf)


def _hist_table(spark, sf):
    return materialize(_hist(spark, sf), "interactions")


def _chain(spark, sf, cfg=None):
    """Interactions and similarity lists of a recommendation chain, each
    materialized once (as the daily job does)."""
    hist = _hist_table(spark, sf)
    return hist, materialize(item_similarity(hist, cfg or PROD), "similarity")


def _labels(spark, sf, label="code", complete=False):
    return materialize(dictionary_labels(fx.part_dictionary(spark, sf, complete), label), "labels")


def _parsed(spark, sf):
    return explode_history(fx.basket_features(spark, sf))


def q_parse_feature(spark, sf):
    return _parsed(spark, sf)


def q_parse_item_ids(spark, sf):
    return explode_history(fx.basket_features(spark, sf), item_as_string=True).select(
        "user_id", "pos", "item")


def q_parse_text_items(spark, sf):
    return explode_history(fx.basket_features(spark, sf), item_as_string=True)


def q_history_last_pref(spark, sf):
    return last_preference(_parsed(spark, sf))


def q_min_history_filter(spark, sf):
    return min_history(fx.basket_interactions(spark, sf), PROD.min_items)


def q_user_count(spark, sf):
    return fx.basket_features(spark, sf).agg(F.count(F.lit(1)).alias("users"))


def q_user_ids(spark, sf):
    """The ids themselves depend on the partition layout; what they promise
    does not: one per row, all distinct, none null (P9)."""
    ids = unique_user_ids(fx.basket_features(spark, sf))
    return ids.agg(F.count(F.lit(1)).alias("users"), F.countDistinct("uid").alias("ids"),
                   F.count_if(F.col("uid").isNull()).alias("nulls"))


def q_sample_users_md5(spark, sf):
    return sample_users(_hist(spark, sf), SAMPLE_RATE)


def q_sample_users_exact(spark, sf):
    """Exactly floor(users x rate) users, orders as users (P10)."""
    return sample_users_exact(materialize(fx.basket_interactions(spark, sf), "interactions"),
                              SAMPLE_RATE)


def _item_vectors(spark, sf):
    """Item vectors over orders as users, written."""
    base = materialize(fx.basket_interactions(spark, sf), "interactions")
    ids = materialize(dense_user_ids(base), "user-ids")
    return materialize(item_vectors(base, ids, RANGE), "item-vectors")


def q_item_vectors(spark, sf):
    """Bitmaps by item and user range, as their numbers of users."""
    return _item_vectors(spark, sf).select("item", "user_range", "users")


def q_item_vectors_popularity(spark, sf):
    """Users of an item, from its bitmaps."""
    return vector_popularity(_item_vectors(spark, sf))


def q_item_vectors_overlap(spark, sf):
    """Users that hold both of two items, from bitmaps, for each item and the
    one with the next id."""
    vectors = _item_vectors(spark, sf)
    items = vectors.select(F.col("item").alias("i")).distinct()
    return vector_overlap(vectors, items.select("i", (F.col("i") + 1).alias("j")))


def q_yesterday_partition(spark, sf):
    return fx.table(spark, sf, "orders").select(
        "o_orderkey", day_before(F.col("o_orderdate")).alias("stat_date"))


def q_dictionary_not_null(spark, sf):
    return fx.part_dictionary(spark, sf).where(F.col("column_index").isNotNull())


def q_dictionary_max_id(spark, sf):
    return max_item_id(fx.part_dictionary(spark, sf))


def q_item_popularity(spark, sf):
    return item_popularity(filtered_interactions(_hist(spark, sf), PROD))


def q_popularity_summary(spark, sf):
    pop = item_popularity(filtered_interactions(_hist(spark, sf), PROD))
    return popularity_summary(pop, max_item_id(fx.part_dictionary(spark, sf)))


def q_cooccurrence(spark, sf):
    return cooccurrence(_hist_table(spark, sf), PROD)


def q_cosine_similarity(spark, sf):
    return cosine_similarity(_hist_table(spark, sf), PROD)


def q_topn_similar(spark, sf):
    return item_similarity(_hist_table(spark, sf), RAW)


def q_topn_similar_normalized(spark, sf):
    return item_similarity(_hist_table(spark, sf), PROD)


def q_similarity_lists(spark, sf):
    return nested_lists(item_similarity(_hist_table(spark, sf), PROD))


def q_similarity_summary(spark, sf):
    return similarity_summary(item_similarity(_hist_table(spark, sf), PROD))


def q_candidates(spark, sf):
    hist, sim = _chain(spark, sf)
    return candidates(hist, sim)


def q_unseen_candidates(spark, sf):
    hist, sim = _chain(spark, sf)
    return unseen_candidates(hist, sim)


def q_score_candidate_side(spark, sf):
    hist, sim = _chain(spark, sf)
    return score_candidate_side(hist, sim)


def q_score_candidate_side_split(spark, sf):
    """Both routes of the candidate-side score: items in more than 3 lists
    are found from the candidate."""
    hist, sim = _chain(spark, sf)
    return score_candidate_side(hist, sim, reverse_limit=3)


def q_score_source_side(spark, sf):
    hist, sim = _chain(spark, sf)
    return score_source_side(hist, sim)


def q_recommend_topk(spark, sf):
    hist, sim = _chain(spark, sf)
    scored = score_candidate_side(hist, sim, best=TOP_K)
    return top_per_group(scored, "user_id", [F.col("score").desc(), F.col("item").asc()], TOP_K)


def q_recommend_labelled(spark, sf):
    hist, sim = _chain(spark, sf)
    return recommend(hist, sim, _labels(spark, sf), PROD)


def q_watched_labels(spark, sf):
    return watched_labels(_hist(spark, sf), _labels(spark, sf, "name"))


def _sink_source_recom(spark, sf):
    hist, sim = _chain(spark, sf)
    recs = recommend(hist, sim, _labels(spark, sf), PROD)
    return source_recom(hist.select("user_id").distinct(), recs)


def q_sink_source_recom(spark, sf):
    return _sink_source_recom(spark, sf)


def q_sink_user_watched(spark, sf):
    hist, sim = _chain(spark, sf)
    names = _labels(spark, sf, "name")
    recs = recommend(hist, sim, names, PROD)
    return user_watched(hist.select("user_id").distinct(), watched_labels(hist, names), recs)


def q_sink_user_watched_trailing(spark, sf):
    """The K5 layout as the original writes it: a separator after every
    watched label (F6, Q14); the recommended list has no trailing comma."""
    hist, sim = _chain(spark, sf)
    names = _labels(spark, sf, "name")
    recs = recommend(hist, sim, names, PROD)
    watched = watched_labels(hist, names, ",", trailing=True)
    return user_watched(hist.select("user_id").distinct(), watched, recs)


def q_sink_scored_list(spark, sf):
    hist, sim = _chain(spark, sf, VECTOR_JOB)
    codes = _labels(spark, sf, "code", complete=True)
    recs = recommend(hist, sim, codes, VECTOR_JOB)
    return scored_list(hist.select("user_id").distinct(), recs, VECTOR_JOB.score_decimals)


def q_vector_topk(spark, sf):
    return vector_topk(fx.embeddings(spark, sf), "vec_id", "embedding", VECTOR_K)


def q_vector_topk_2dp(spark, sf):
    return vector_topk(fx.embeddings(spark, sf), "vec_id", "embedding", VECTOR_K, decimals=2)


def q_vector_topk_copies(spark, sf):
    """Every vector twice: each has a copy at cosine 1, and ties everywhere."""
    vecs = fx.embeddings(spark, sf)
    copies = vecs.select((F.col("vec_id") + COPY_SHIFT).alias("vec_id"), "embedding")
    return vector_topk(vecs.unionByName(copies), "vec_id", "embedding", VECTOR_K)


def q_vector_topk_pruned(spark, sf):
    """By bounds, in small blocks, so that groups, blocks and slices are many."""
    return vector_topk_pruned(fx.embeddings(spark, sf), "vec_id", "embedding", VECTOR_K,
                              block_rows=VECTOR_BLOCK)


def q_vector_cosine_next(spark, sf):
    """Cosine of each vector and the one with the next id (F2)."""
    a = fx.embeddings(spark, sf)
    b = a.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("next"))
    return a.join(b, "vec_id").select(
        "vec_id", F.round(cosine(F.col("embedding"), F.col("next")), 6).alias("sim"))


def _run_job(spark, sf, cfg, complete, by_name=False):
    """Write both inputs as day-partitioned tables, run the daily job for one
    of two days and read its partition back (S1, S2, E5-E7). Every order is a
    user, also one without lines; the other day holds rows that a strict
    parse refuses, so the job must not read it."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    name = f"itemwise_job_{uuid.uuid4().hex[:12]}"
    features, dictionary = f"{root}/{name}/features", f"{root}/{name}/dictionary"
    orders = fx.table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("user_id"))
    rows = orders.join(fx.basket_features(spark, sf), "user_id", "full").select(
        F.col("user_id").alias("imei"), F.coalesce("feature", F.lit("")).alias("feature"),
        F.lit(DAYS[1]).alias("stat_date"))
    other = rows.select("imei", F.lit("no token").alias("feature"),
                        F.lit(DAYS[0]).alias("stat_date"))
    rows = rows.unionByName(other)
    items = fx.part_dictionary(spark, sf, complete).withColumn("stat_date", F.lit(DAYS[1]))
    for df, path in ((rows, features), (items, dictionary)):
        writer = df.write.partitionBy("stat_date")
        if by_name:
            writer.option("path", path).saveAsTable(path.rsplit("/", 1)[1] + f"_{name}")
        else:
            writer.parquet(path)
    if by_name:
        features, dictionary = f"features_{name}", f"dictionary_{name}"
    ensure_table(spark, name, LAYOUT_COLUMNS[cfg.layout], location=f"{root}/{name}/recs")
    day = run_recommendations(spark, features, dictionary, name, cfg, stat_date=DAYS[1])
    return spark.table(name).where(F.col("stat_date") == day)


def q_job_source_recom(spark, sf):
    """The daily job: similarity from a sample of users, scores for all."""
    return _run_job(spark, sf, RecConfig(sample_rate=SAMPLE_RATE, top_n=TOP_N, top_k=TOP_K), False)


def q_job_scored_list(spark, sf):
    return _run_job(spark, sf, vector_job_config(), True)


def q_job_by_table_name(spark, sf):
    """The daily job on catalog tables instead of paths."""
    return _run_job(spark, sf, RecConfig(sample_rate=SAMPLE_RATE, top_n=TOP_N, top_k=TOP_K), False,
                    by_name=True)


def q_partition_rerun_failure(spark, sf):
    """Two days are written; a rerun of the first fails on its last row: both
    days keep their rows (K2, E7)."""
    out = materialize(_sink_source_recom(spark, sf), "recs")
    root = ensure_checkpoint_dir(spark).rstrip("/")
    name = f"itemwise_rerun_{uuid.uuid4().hex[:12]}"
    ensure_table(spark, name, LAYOUT_COLUMNS["source_recom"], location=f"{root}/tables/{name}")
    for day in DAYS:
        overwrite_partition(out, name, day)
    last = out.agg(F.max("source_id")).first()[0]
    broken = out.withColumn("recom_id", F.when(F.col("source_id") == last, F.raise_error(
        F.lit("item without label"))).otherwise(F.col("recom_id")))
    try:
        overwrite_partition(broken, name, DAYS[0])
    except Exception as e:  # noqa: BLE001
        if "item without label" not in str(e):
            raise
    else:
        raise AssertionError("the rerun was to fail")
    return spark.table(name)


def q_partition_overwrite(spark, sf):
    """Write the production layout into two days of a partitioned table,
    then rerun the first day: the other day must keep its rows (K1, K2)."""
    out = materialize(_sink_source_recom(spark, sf), "recs")
    root = ensure_checkpoint_dir(spark).rstrip("/")
    name = f"itemwise_recs_{uuid.uuid4().hex[:12]}"
    ensure_table(spark, name, LAYOUT_COLUMNS["source_recom"],
                 location=f"{root}/tables/{name}")
    overwrite_partition(out, name, DAYS[0])
    overwrite_partition(out, name, DAYS[1])
    overwrite_partition(out, name, DAYS[0])
    return spark.table(name)


def q_preview(spark, sf):
    """The first users are cut before anything is scored."""
    hist, sim = _chain(spark, sf)
    users = materialize(preview(hist.select("user_id").distinct(), PREVIEW_ROWS, ["user_id"]),
                        "preview-users")
    few = hist.join(users, "user_id", "left_semi")
    names = _labels(spark, sf, "name")
    return user_watched(users, watched_labels(few, names), recommend(few, sim, names, PROD))


def q_preview_lists(spark, sf):
    """The first similarity lists."""
    _, sim = _chain(spark, sf)
    return nested_lists(sim.join(preview(sim.select("i").distinct(), PREVIEW_LISTS, ["i"]), "i",
                                 "left_semi"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "parse_feature": q_parse_feature,
    "parse_item_ids": q_parse_item_ids,
    "history_last_pref": q_history_last_pref,
    "min_history_filter": q_min_history_filter,
    "user_count": q_user_count,
    "user_ids": q_user_ids,
    "sample_users_md5": q_sample_users_md5,
    "yesterday_partition": q_yesterday_partition,
    "dictionary_not_null": q_dictionary_not_null,
    "dictionary_max_id": q_dictionary_max_id,
    "item_popularity": q_item_popularity,
    "popularity_summary": q_popularity_summary,
    "cooccurrence": q_cooccurrence,
    "cosine_similarity": q_cosine_similarity,
    "topn_similar": q_topn_similar,
    "topn_similar_normalized": q_topn_similar_normalized,
    "similarity_lists": q_similarity_lists,
    "similarity_summary": q_similarity_summary,
    "candidates": q_candidates,
    "unseen_candidates": q_unseen_candidates,
    "score_candidate_side": q_score_candidate_side,
    "score_source_side": q_score_source_side,
    "recommend_topk": q_recommend_topk,
    "recommend_labelled": q_recommend_labelled,
    "watched_labels": q_watched_labels,
    "sink_source_recom": q_sink_source_recom,
    "sink_user_watched": q_sink_user_watched,
    "sink_user_watched_trailing": q_sink_user_watched_trailing,
    "sink_scored_list": q_sink_scored_list,
    "vector_topk": q_vector_topk,
    "vector_topk_2dp": q_vector_topk_2dp,
    "vector_topk_copies": q_vector_topk_copies,
    "vector_cosine_next": q_vector_cosine_next,
    "score_candidate_side_split": q_score_candidate_side_split,
    "parse_text_items": q_parse_text_items,
    "job_source_recom": q_job_source_recom,
    "job_scored_list": q_job_scored_list,
    "partition_overwrite": q_partition_overwrite,
    "preview": q_preview,
    "preview_lists": q_preview_lists,
    "sample_users_exact": q_sample_users_exact,
    "item_vectors": q_item_vectors,
    "item_vectors_popularity": q_item_vectors_popularity,
    "item_vectors_overlap": q_item_vectors_overlap,
    "vector_topk_pruned": q_vector_topk_pruned,
    "job_by_table_name": q_job_by_table_name,
    "partition_rerun_failure": q_partition_rerun_failure,
}


# ------------------------------------------------------------------ SQL side
# Written for DuckDB over the driver's views. Each entry is a CTE.

CTE = {
    "ia": """
  SELECT CAST(o.o_custkey AS VARCHAR) AS user_id, CAST(l.l_partkey AS INTEGER) AS item,
         CAST(SUM(l.l_quantity) AS INTEGER) AS pref
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  GROUP BY 1, 2""",
    "users": "SELECT DISTINCT user_id FROM ia",
    "fe": """
  SELECT CAST(l_orderkey AS VARCHAR) AS user_id,
         string_agg(CAST(l_partkey AS VARCHAR) || ':' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR),
                    ' ' ORDER BY l_linenumber, l_partkey, l_quantity) AS feature
  FROM lineitem
  GROUP BY 1""",
    "tk": """
  SELECT user_id, list_filter(string_split(feature, ' '), lambda t: t <> '') AS toks FROM fe""",
    "ex": "SELECT user_id, unnest(toks) AS tok, generate_subscripts(toks, 1) AS pos1 FROM tk",
    "parsed": """
  SELECT user_id, CAST(pos1 - 1 AS INTEGER) AS pos,
         CAST(split_part(tok, ':', 1) AS INTEGER) AS item,
         CAST(split_part(tok, ':', 2) AS INTEGER) AS pref
  FROM ex""",
    "bk": """
  SELECT CAST(l_orderkey AS VARCHAR) AS user_id, CAST(l_partkey AS INTEGER) AS item,
         CAST(SUM(l_quantity) AS INTEGER) AS pref
  FROM lineitem GROUP BY 1, 2""",
    "dict": """
  SELECT CASE WHEN p_size < 46 THEN CAST(p_partkey AS BIGINT) END AS column_index,
         p_name AS name, 'P' || CAST(p_partkey AS VARCHAR) AS code
  FROM part""",
    "codes": """
  SELECT column_index, MAX(code) AS label FROM dict WHERE column_index IS NOT NULL
  GROUP BY column_index""",
    "names": """
  SELECT column_index, MAX(name) AS label FROM dict WHERE column_index IS NOT NULL
  GROUP BY column_index""",
    "all_codes": """
  SELECT CAST(p_partkey AS BIGINT) AS column_index, MAX('P' || CAST(p_partkey AS VARCHAR)) AS label
  FROM part GROUP BY 1""",
    "mx": "SELECT MAX(column_index) AS m FROM dict WHERE column_index IS NOT NULL",
    "base": """
  SELECT user_id, item FROM ia
  WHERE user_id IN (SELECT user_id FROM ia GROUP BY user_id HAVING COUNT(*) >= 2)""",
    "pop": "SELECT item, COUNT(*) AS n FROM base GROUP BY item",
    "co": """
  SELECT a.item AS i, b.item AS j, COUNT(*) AS c
  FROM base a JOIN base b ON a.user_id = b.user_id AND a.item <> b.item
  GROUP BY a.item, b.item""",
    "cs": """
  SELECT co.i, co.j, co.c / sqrt(CAST(p1.n AS DOUBLE) * p2.n) AS sim
  FROM co JOIN pop p1 ON p1.item = co.i JOIN pop p2 ON p2.item = co.j""",
    "raw": f"""
  SELECT i, j, sim, rk FROM (
    SELECT i, j, sim, CAST(row_number() OVER (PARTITION BY i ORDER BY sim DESC, j) AS INTEGER) AS rk
    FROM cs) t
  WHERE rk <= {TOP_N}""",
    "sim": """
  SELECT i, j, CASE WHEN mx > 0 THEN sim / mx ELSE sim END AS sim, rk
  FROM (SELECT i, j, sim, rk, MAX(sim) OVER (PARTITION BY i) AS mx FROM raw) t""",
    "cand": "SELECT DISTINCT h.user_id, s.j AS item FROM ia h JOIN sim s ON h.item = s.i",
    "unseen": """
  SELECT c.user_id, c.item FROM cand c
  WHERE NOT EXISTS (SELECT 1 FROM ia h WHERE h.user_id = c.user_id AND h.item = c.item)""",
    "cscore": """
  SELECT u.user_id, u.item, round(COALESCE(SUM(h.pref * s.sim), 0.0), 6) AS score
  FROM unseen u
  LEFT JOIN sim s ON s.i = u.item
  LEFT JOIN ia h ON h.user_id = u.user_id AND h.item = s.j
  GROUP BY u.user_id, u.item""",
    "sscore": """
  SELECT g.user_id, g.item, g.score FROM (
    SELECT h.user_id, s.j AS item, round(SUM(h.pref * s.sim), 6) AS score
    FROM ia h JOIN sim s ON h.item = s.i GROUP BY h.user_id, s.j) g
  WHERE NOT EXISTS (SELECT 1 FROM ia h WHERE h.user_id = g.user_id AND h.item = g.item)""",
    "recs": f"""
  SELECT user_id, item, label, score, rk FROM (
    SELECT s.user_id, s.item, l.label, s.score,
           CAST(row_number() OVER (PARTITION BY s.user_id ORDER BY s.score DESC, s.item) AS INTEGER) AS rk
    FROM cscore s JOIN codes l ON l.column_index = s.item) t
  WHERE rk <= {TOP_K}""",
    "name_recs": f"""
  SELECT user_id, item, label, score, rk FROM (
    SELECT s.user_id, s.item, l.label, s.score,
           CAST(row_number() OVER (PARTITION BY s.user_id ORDER BY s.score DESC, s.item) AS INTEGER) AS rk
    FROM cscore s JOIN names l ON l.column_index = s.item) t
  WHERE rk <= {TOP_K}""",
    "watched_trailing": """
  SELECT user_id, string_agg(label || ',', '' ORDER BY label) AS watched FROM (
    SELECT DISTINCT h.user_id, COALESCE(n.label, '') AS label
    FROM ia h LEFT JOIN names n ON n.column_index = h.item) t
  GROUP BY user_id""",
    "sink_uwt": """
  SELECT u.user_id AS "user", COALESCE(MAX(w.watched), '') AS watched,
         COALESCE(string_agg(r.label, ',' ORDER BY r.rk), '') AS sim_items
  FROM users u LEFT JOIN watched_trailing w ON w.user_id = u.user_id
  LEFT JOIN name_recs r ON r.user_id = u.user_id
  GROUP BY u.user_id""",
    "watched": """
  SELECT user_id, string_agg(label, ',' ORDER BY label) AS watched FROM (
    SELECT DISTINCT h.user_id, COALESCE(n.label, '') AS label
    FROM ia h LEFT JOIN names n ON n.column_index = h.item) t
  GROUP BY user_id""",
    "sink_sr": """
  SELECT u.user_id AS source_id, COALESCE(string_agg(r.label, ',' ORDER BY r.rk), '') AS recom_id
  FROM users u LEFT JOIN recs r ON r.user_id = u.user_id
  GROUP BY u.user_id""",
    "sink_uw": """
  SELECT u.user_id AS "user", COALESCE(MAX(w.watched), '') AS watched,
         COALESCE(string_agg(r.label, ',' ORDER BY r.rk), '') AS sim_items
  FROM users u LEFT JOIN watched w ON w.user_id = u.user_id
  LEFT JOIN name_recs r ON r.user_id = u.user_id
  GROUP BY u.user_id""",
    # vector job: raw top 10 lists, source-side scores, complete code dictionary
    "vsscore": """
  SELECT g.user_id, g.item, g.score FROM (
    SELECT h.user_id, s.j AS item, round(SUM(h.pref * s.sim), 6) AS score
    FROM ia h JOIN raw s ON h.item = s.i GROUP BY h.user_id, s.j) g
  WHERE NOT EXISTS (SELECT 1 FROM ia h WHERE h.user_id = g.user_id AND h.item = g.item)""",
    "vrecs": """
  SELECT user_id, item, label, score, rk FROM (
    SELECT s.user_id, s.item, l.label, s.score,
           CAST(row_number() OVER (PARTITION BY s.user_id ORDER BY s.score DESC, s.item) AS INTEGER) AS rk
    FROM vsscore s JOIN all_codes l ON l.column_index = s.item) t
  WHERE rk <= 10""",
    "sink_sl": """
  SELECT u.user_id AS item,
         COALESCE(string_agg(r.label || ':' || printf('%.6f', r.score) || ', ', '' ORDER BY r.rk), '')
           AS sim_items
  FROM users u LEFT JOIN vrecs r ON r.user_id = u.user_id
  GROUP BY u.user_id""",
}

# Dependencies of each CTE, so a query lists only what it needs, in order.
DEPS = {
    "users": ["ia"], "tk": ["fe"], "ex": ["tk"], "parsed": ["ex"], "codes": ["dict"],
    "names": ["dict"], "mx": ["dict"], "base": ["ia"], "pop": ["base"], "co": ["base"],
    "cs": ["co", "pop"], "raw": ["cs"], "sim": ["raw"], "cand": ["ia", "sim"],
    "unseen": ["cand"], "cscore": ["unseen"], "sscore": ["ia", "sim"],
    "recs": ["cscore", "codes"], "name_recs": ["cscore", "names"], "watched": ["ia", "names"],
    "sink_sr": ["users", "recs"], "sink_uw": ["users", "watched", "name_recs"],
    "watched_trailing": ["ia", "names"], "sink_uwt": ["users", "watched_trailing", "name_recs"],
    "vsscore": ["ia", "raw"], "vrecs": ["vsscore", "all_codes"], "sink_sl": ["users", "vrecs"],
}


_SAMPLED = (f"('0x' || substr(md5(user_id), 1, {HASH_HEX_DIGITS}))::BIGINT "
            f"< {int(SAMPLE_RATE * HASH_RANGE)}")

# The job's own inputs: histories parsed from feature rows, orders as users.
JOB_CTE = {
    "ia": "SELECT user_id, item, arg_max(pref, pos) AS pref FROM parsed GROUP BY user_id, item",
    "users": """
  SELECT CAST(o_orderkey AS VARCHAR) AS user_id FROM orders
  UNION SELECT CAST(l_orderkey AS VARCHAR) FROM lineitem""",
}
JOB_DEPS = {"ia": ["parsed"], "users": []}


def _with(names: list[str], final: str, own: dict | None = None, deps: dict | None = None) -> str:
    order: list[str] = []
    cte, needs = CTE | (own or {}), DEPS | (deps or {})

    def visit(n: str) -> None:
        for d in needs.get(n, []):
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    body = ",\n".join(f"{n} AS ({cte[n]}\n)" for n in order)
    return f"WITH {body}\n{final}"


def _vector_sql(source: str, decimals: int) -> str:
    return f"""
WITH pairs AS (
  SELECT a.vec_id, b.vec_id AS nbr_id,
         round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), {decimals})
           AS sim
  FROM {source} a JOIN {source} b ON a.vec_id <> b.vec_id)
SELECT vec_id, nbr_id, sim, rk FROM (
  SELECT vec_id, nbr_id, sim,
         CAST(row_number() OVER (PARTITION BY vec_id ORDER BY sim DESC, nbr_id) AS INTEGER) AS rk
  FROM pairs WHERE sim IS NOT NULL) t
WHERE rk <= {VECTOR_K}"""


SQL: dict[str, str] = {
    "parse_feature": _with(["parsed"], "SELECT user_id, pos, item, pref FROM parsed"),
    "parse_item_ids": _with(["ex"], """
SELECT user_id, CAST(pos1 - 1 AS INTEGER) AS pos, split_part(tok, ':', 1) AS item FROM ex"""),
    "history_last_pref": _with(["parsed"], """
SELECT user_id, item, arg_max(pref, pos) AS pref FROM parsed GROUP BY user_id, item"""),
    "min_history_filter": _with(["bk"], """
SELECT bk.user_id, bk.item, ks.k
FROM bk JOIN (SELECT user_id, COUNT(*) AS k FROM bk GROUP BY user_id) ks ON bk.user_id = ks.user_id
WHERE ks.k >= 2"""),
    "user_count": _with(["fe"], "SELECT COUNT(*) AS users FROM fe"),
    "sample_users_md5": _with(["ia"], f"""
SELECT user_id, item, pref FROM ia
WHERE {_SAMPLED}"""),
    "user_ids": _with(["fe"], "SELECT COUNT(*) AS users, COUNT(*) AS ids, 0::BIGINT AS nulls FROM fe"),
    "parse_text_items": _with(["ex"], """
SELECT user_id, CAST(pos1 - 1 AS INTEGER) AS pos, split_part(tok, ':', 1) AS item,
       CAST(split_part(tok, ':', 2) AS INTEGER) AS pref FROM ex"""),
    "yesterday_partition": """
SELECT o_orderkey,
       CAST(strftime(CAST(o_orderdate AS DATE) - INTERVAL 1 DAY, '%Y%m%d') AS BIGINT) AS stat_date
FROM orders""",
    "dictionary_not_null": _with(["dict"], """
SELECT column_index, name, code FROM dict WHERE column_index IS NOT NULL"""),
    "dictionary_max_id": _with(["mx"], "SELECT m AS max_index FROM mx"),
    "item_popularity": _with(["pop"], "SELECT item, n FROM pop"),
    "popularity_summary": _with(["pop", "mx"], """
SELECT (SELECT m FROM mx) + 1 AS n_length, MAX(n) AS n_max,
       (SELECT m FROM mx) + 1 - COUNT(*) FILTER (WHERE item >= 0 AND item <= (SELECT m FROM mx))
         AS n_zero
FROM pop"""),
    "cooccurrence": _with(["co"], "SELECT i, j, c FROM co"),
    "cosine_similarity": _with(["cs"], "SELECT i, j, sim FROM cs"),
    "topn_similar": _with(["raw"], "SELECT i, j, sim, rk FROM raw"),
    "topn_similar_normalized": _with(["sim"], "SELECT i, j, sim, rk FROM sim"),
    "similarity_lists": _with(["sim"], """
SELECT i, list(j ORDER BY rk) AS items, list(sim ORDER BY rk) AS sims FROM sim GROUP BY i"""),
    "similarity_summary": _with(["sim"], """
SELECT COUNT(DISTINCT i) AS items, COUNT(*) AS entries,
       COUNT(*) / COUNT(DISTINCT i) AS avg_list_len
FROM sim"""),
    "candidates": _with(["cand"], "SELECT user_id, item FROM cand"),
    "unseen_candidates": _with(["unseen"], "SELECT user_id, item FROM unseen"),
    "score_candidate_side": _with(["cscore"], "SELECT user_id, item, score FROM cscore"),
    "score_candidate_side_split": _with(["cscore"], "SELECT user_id, item, score FROM cscore"),
    "score_source_side": _with(["sscore"], "SELECT user_id, item, score FROM sscore"),
    "recommend_topk": _with(["cscore"], f"""
SELECT user_id, item, score, rk FROM (
  SELECT user_id, item, score,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item) AS INTEGER) AS rk
  FROM cscore) t
WHERE rk <= {TOP_K}"""),
    "recommend_labelled": _with(["recs"], "SELECT user_id, item, label, score, rk FROM recs"),
    "watched_labels": _with(["watched"], "SELECT user_id, watched FROM watched"),
    "sink_source_recom": _with(["sink_sr"], "SELECT source_id, recom_id FROM sink_sr"),
    "sink_user_watched": _with(["sink_uw"], 'SELECT "user", watched, sim_items FROM sink_uw'),
    "sink_user_watched_trailing": _with(["sink_uwt"],
                                        'SELECT "user", watched, sim_items FROM sink_uwt'),
    "sink_scored_list": _with(["sink_sl"], "SELECT item, sim_items FROM sink_sl"),
    "vector_topk": _vector_sql("embeddings", 6),
    "vector_topk_2dp": _vector_sql("embeddings", 2),
    "vector_topk_copies": _vector_sql(f"""(SELECT vec_id, embedding FROM embeddings
  UNION ALL SELECT vec_id + {COPY_SHIFT}, embedding FROM embeddings)""", 6),
    "vector_cosine_next": """
SELECT a.vec_id, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]),
                                              CAST(b.embedding AS DOUBLE[])), 6) AS sim
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""",
    "partition_overwrite": _with(["sink_sr"], f"""
SELECT source_id, recom_id, CAST({DAYS[0]} AS BIGINT) AS stat_date FROM sink_sr
UNION ALL
SELECT source_id, recom_id, CAST({DAYS[1]} AS BIGINT) AS stat_date FROM sink_sr"""),
    "job_source_recom": _with(["sink_sr"], f"""
SELECT source_id, recom_id, CAST({DAYS[1]} AS BIGINT) AS stat_date FROM sink_sr""",
                              JOB_CTE | {"base": CTE["base"] + f" AND {_SAMPLED}"}, JOB_DEPS),
    "job_scored_list": _with(["sink_sl"], f"""
SELECT item, sim_items, CAST({DAYS[1]} AS BIGINT) AS stat_date FROM sink_sl""",
                             JOB_CTE, JOB_DEPS),
    "sample_users_exact": _with(["bk"], f"""
SELECT bk.user_id, bk.item, bk.pref FROM bk JOIN (
  SELECT user_id, row_number() OVER (
    ORDER BY ('0x' || substr(md5(user_id), 1, {HASH_HEX_DIGITS}))::BIGINT, user_id) AS place
  FROM (SELECT DISTINCT user_id FROM bk)) p ON p.user_id = bk.user_id
WHERE place <= floor((SELECT COUNT(DISTINCT user_id) FROM bk) * {SAMPLE_RATE}::DOUBLE)"""),
    "item_vectors": _with(["bk"], f"""
SELECT item, uid // {RANGE} AS user_range, COUNT(DISTINCT uid) AS users
FROM bk JOIN (
  SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS uid
  FROM (SELECT DISTINCT user_id FROM bk)) u ON u.user_id = bk.user_id
GROUP BY item, uid // {RANGE}"""),
    "item_vectors_popularity": _with(["bk"], """
SELECT item, COUNT(DISTINCT user_id) AS n FROM bk GROUP BY item"""),
    "item_vectors_overlap": _with(["bk"], """
SELECT a.item AS i, b.item AS j, COUNT(DISTINCT a.user_id) AS c
FROM bk a JOIN bk b ON a.user_id = b.user_id AND b.item = a.item + 1 GROUP BY a.item, b.item"""),
    "vector_topk_pruned": _vector_sql("embeddings", 6),
    "preview_lists": _with(["sim"], f"""
SELECT i, list(j ORDER BY rk) AS items, list(sim ORDER BY rk) AS sims FROM sim GROUP BY i
ORDER BY i LIMIT {PREVIEW_LISTS}"""),
    "preview": _with(["sink_uw"], f"""
SELECT "user", watched, sim_items FROM sink_uw ORDER BY "user" LIMIT {PREVIEW_ROWS}"""),
}
# Other routes to the same rows.
SQL["job_by_table_name"] = SQL["job_source_recom"]
SQL["partition_rerun_failure"] = SQL["partition_overwrite"]
