"""Inputs in the job's data model, derived by Spark from the driver tables
(``orders``, ``lineitem``, ``part``, ``embeddings``) so their size grows
with the scale factor. The same derivations exist as SQL in
``itemwise.plans.catalog`` for the DuckDB oracle.

* users are customers (``o_custkey``), items are parts (``l_partkey``);
* the feature string of a customer lists one ``part:quantity`` token per
  line item, in ``(l_orderkey, l_linenumber, l_partkey, l_quantity)`` order;
* the item dictionary is ``part`` with ``code = 'P' || p_partkey``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed fixture values: parts of size 46 to 50 have no dictionary id, so
# the "id is null" and "candidate has no label" paths are exercised.
MISSING_ID_MIN_SIZE = 46


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey",
                                                    "l_quantity")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey)


def order_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(user_id string, item int, pref int)``: one row per customer and
    part, preference = total quantity ordered."""
    return (_order_lines(spark, sf_dir)
            .groupBy(F.col("o_custkey").cast("string").alias("user_id"),
                     F.col("l_partkey").cast("int").alias("item"))
            .agg(F.sum("l_quantity").cast("int").alias("pref")))


def basket_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as users: ``(user_id, item, pref)`` per order and part. Many
    orders hold one part only, which exercises the minimum-history filter."""
    return (table(spark, sf_dir, "lineitem")
            .groupBy(F.col("l_orderkey").cast("string").alias("user_id"),
                     F.col("l_partkey").cast("int").alias("item"))
            .agg(F.sum("l_quantity").cast("int").alias("pref")))


def order_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table of the original job, ``(user_id, feature)``: one
    row per customer, tokens ``part:quantity`` joined by spaces. Repeated
    parts stay repeated (last token wins when parsed). A row holds a whole
    customer history, so this builds small test inputs only (job tests);
    registered queries parse ``basket_features``."""
    token = F.concat(F.col("l_partkey").cast("string"), F.lit(":"),
                     F.col("l_quantity").cast("int").cast("string"))
    entry = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", token.alias("tok"))
    return (_order_lines(spark, sf_dir)
            .groupBy(F.col("o_custkey").cast("string").alias("user_id"))
            .agg(F.array_sort(F.collect_list(entry)).alias("entries"))
            .select("user_id",
                    F.array_join(F.transform("entries", lambda e: e["tok"]), " ").alias("feature")))


def basket_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feature table with orders as users, ``(user_id, feature)``: one row
    per order, tokens ``part:quantity`` in line order. Each row gathers the
    lines of one order only, so no row grows with the data; repeated parts in
    an order stay repeated (last token wins when parsed)."""
    token = F.concat(F.col("l_partkey").cast("string"), F.lit(":"),
                     F.col("l_quantity").cast("int").cast("string"))
    entry = F.struct("l_linenumber", "l_partkey", "l_quantity", token.alias("tok"))
    return (table(spark, sf_dir, "lineitem")
            .groupBy(F.col("l_orderkey").cast("string").alias("user_id"))
            .agg(F.array_sort(F.collect_list(entry)).alias("entries"))
            .select("user_id",
                    F.array_join(F.transform("entries", lambda e: e["tok"]), " ").alias("feature")))


def part_dictionary(spark: SparkSession, sf_dir: str, complete: bool = False) -> DataFrame:
    """Item dictionary ``(column_index bigint, name, code)`` from ``part``.
    Unless ``complete``, large parts get a null id."""
    part = table(spark, sf_dir, "part")
    idx = F.col("p_partkey").cast("bigint")
    if not complete:
        idx = F.when(F.col("p_size") < MISSING_ID_MIN_SIZE, idx)
    return part.select(idx.alias("column_index"), F.col("p_name").alias("name"),
                       F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("code"))


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
