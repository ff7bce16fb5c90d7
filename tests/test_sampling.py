"""Deterministic user sampling agrees with its SQL form."""

import duckdb
from pyspark.sql import functions as F

from itemwise.functions import keep_user


def test_hash_sample_matches_duckdb(spark):
    ids = spark.range(0, 3000).select(F.col("id").cast("string").alias("u"))
    got = {r.u for r in ids.where(keep_user(F.col("u"), 0.3)).collect()}
    con = duckdb.connect()
    want = {r[0] for r in con.execute(
        "SELECT CAST(i AS VARCHAR) FROM range(3000) t(i) "
        "WHERE ('0x' || substr(md5(CAST(i AS VARCHAR)), 1, 15))::BIGINT < CAST(0.3::DOUBLE * 1152921504606846976 AS BIGINT)"
    ).fetchall()}
    assert got == want and 700 < len(got) < 1100


def test_rate_one_keeps_everyone(spark):
    ids = spark.range(0, 100).select(F.col("id").cast("string").alias("u"))
    assert ids.where(keep_user(F.col("u"), 1.0)).count() == 100
    assert ids.where(keep_user(F.col("u"), 0.0)).count() == 100


def test_seed_changes_sample(spark):
    ids = spark.range(0, 1000).select(F.col("id").cast("string").alias("u"))
    a = {r.u for r in ids.where(keep_user(F.col("u"), 0.5, "x")).collect()}
    b = {r.u for r in ids.where(keep_user(F.col("u"), 0.5, "y")).collect()}
    assert a != b


def test_bernoulli_feature_sample(spark):
    from itemwise.operators import sample_feature_rows
    feats = spark.range(0, 2000).select(F.col("id").cast("string").alias("user_id"),
                                        F.lit("1:1").alias("feature"))
    kept = sample_feature_rows(feats, 0.25, seed=7).count()
    assert 350 < kept < 650
    assert sample_feature_rows(feats, 1.0).count() == 2000
