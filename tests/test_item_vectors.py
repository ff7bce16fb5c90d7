"""Item vectors as bitmaps (A9) and samples of an exact size (P10)."""

import random

import pytest
from pyspark.sql import functions as F

from itemwise import RecConfig
from itemwise.functions.sampling import user_hash
from itemwise.operators import (dense_user_ids, item_vectors, sample_users_exact, vector_overlap,
                                vector_popularity)
from itemwise.operators import history
from itemwise.plans.similarity import filtered_interactions
from itemwise.session import materialize

SCHEMA = "user_id string, item int, pref int"


@pytest.fixture(scope="module")
def rows():
    """Item 1 is in every history; one user holds a third of all rows."""
    rng = random.Random(4)
    out = {(f"u{u:04d}", 1) for u in range(700)} | {("u0003", i) for i in range(900)}
    out |= {(f"u{rng.randrange(700):04d}", rng.randrange(2, 60)) for _ in range(1500)}
    return [(u, i, 1) for u, i in sorted(out)] + [("u0003", 5, 9), ("u0003", 5, 9)]


@pytest.fixture(scope="module")
def base(spark, rows):
    return materialize(spark.createDataFrame(rows, SCHEMA).repartition(7), "interactions")


def members(bits, users):
    return {i for i in range(users) if bits[i >> 3] >> (i & 7) & 1}


@pytest.mark.parametrize("partitions", [1, 5])
def test_users_are_numbered_in_the_order_of_their_ids(spark, rows, partitions):
    df = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
    got = {r.user_id: r.uid for r in dense_user_ids(df).collect()}
    assert got == {u: n for n, u in enumerate(sorted({u for u, _, _ in rows}))}


@pytest.mark.parametrize("width", [64, 100, 32768])
def test_vectors_hold_exactly_the_histories(spark, rows, base, width):
    ids = materialize(dense_user_ids(base), "user-ids")
    number = {r.user_id: r.uid for r in ids.collect()}
    want = {}
    for u, i, _ in rows:
        want.setdefault((i, number[u] // width), set()).add(number[u] % width)
    got = item_vectors(base, ids, width).collect()
    assert {(r.item, r.user_range): members(r.bits, width) for r in got} == want
    assert all(r.users == len(want[r.item, r.user_range]) for r in got)
    assert all(len(r.bits) <= 4096 for r in got)
    # a hot item is many rows
    assert sum(r.item == 1 for r in got) == -(-len(number) // width)


def test_popularity_and_overlap_from_vectors(spark, rows, base):
    ids = materialize(dense_user_ids(base), "user-ids")
    vectors = materialize(item_vectors(base, ids, 128), "vectors")
    held = {}
    for u, i, _ in rows:
        held.setdefault(i, set()).add(u)
    assert {r.item: r.n for r in vector_popularity(vectors).collect()} == {
        i: len(us) for i, us in held.items()}
    pairs = [(i, j) for i in range(0, 40) for j in range(i + 1, 40, 3)] + [(1, 2), (5000, 1)]
    got = {(r.i, r.j): r.c for r in vector_overlap(
        vectors, spark.createDataFrame(pairs, "i int, j int")).collect()}
    assert got == {(i, j): len(held[i] & held[j]) for i, j in pairs
                   if held.get(i, set()) & held.get(j, set())}


def test_bitmaps_are_as_long_as_their_range(base):
    """No 4 KB bitmaps for short ranges, and none in a shuffle."""
    ids = materialize(dense_user_ids(base), "user-ids")
    vectors = item_vectors(base, ids, 100)
    assert {len(r.bits) for r in vectors.collect()} == {13}
    plan = vectors._jdf.queryExecution().executedPlan().toString()
    lines = [line for line in plan.splitlines() if "bitmap_construct_agg" in line or "Exchange" in line]
    assert sum("bitmap_construct_agg" in line for line in lines[:2]) == 2


def test_no_interactions(spark, base):
    none = base.where("item < -1")
    ids = materialize(dense_user_ids(none), "user-ids")
    assert ids.count() == 0 and item_vectors(none, ids).count() == 0
    assert sample_users_exact(none, 0.5).count() == 0


def test_range_must_fit_a_bitmap(base):
    with pytest.raises(ValueError):
        item_vectors(base, base, 40_000)


@pytest.mark.parametrize("rate", [0.0001, 0.1, 0.5, 0.9999, 1.0, 0.0])
def test_exact_sample(spark, rows, base, rate):
    users = sorted({u for u, _, _ in rows})
    hashes = {r.u: r.h for r in spark.createDataFrame([(u,) for u in users], "u string").select(
        "u", user_hash(F.col("u"), "seed").alias("h")).collect()}
    ranked = sorted(users, key=lambda u: (hashes[u], u))
    want = set(ranked[: int(len(users) * rate)] if 0 < rate < 1 else users)
    for partitions in (1, 6):
        got = sample_users_exact(base.repartition(partitions), rate, "seed")
        assert {r.user_id for r in got.select("user_id").distinct().collect()} == want
        assert got.count() == sum(u in want for u, _, _ in rows)


def test_exact_sample_of_equal_hashes(spark, monkeypatch):
    """Users of one hash are taken in the order of their ids."""
    monkeypatch.setattr(history, "user_hash", lambda user, seed="": F.when(
        user < "u03", F.lit(5)).otherwise(F.lit(1 << 40)).cast("bigint"))
    df = spark.createDataFrame([(f"u{u:02d}", 1, 1) for u in range(20)] + [(None, 1, 1)], SCHEMA)
    for rate, n in ((0.1, 2), (0.15, 3), (0.5, 10)):
        got = sorted(r.user_id for r in sample_users_exact(df, rate).collect())
        assert got == [f"u{u:02d}" for u in range(n)]


def test_job_samples_exactly_when_asked(base):
    cfg = RecConfig(sample_rate=0.25, sample_exact=True, min_items=1)
    kept = filtered_interactions(base, cfg)
    assert kept.select("user_id").distinct().count() == int(700 * 0.25)
