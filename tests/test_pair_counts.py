"""Pairs counted by buckets of items, with and without hot items."""

import random
from collections import Counter

import pytest

from itemwise import RecConfig, item_similarity
from itemwise.operators import pair_counts
from itemwise.plans import cooccurrence


def _rows(shift=0):
    rng = random.Random(3)
    rows = {(f"u{rng.randrange(40)}", rng.randrange(60) + shift) for _ in range(500)}
    rows |= {(f"u{u}", 1 + shift) for u in range(40)} | {("u0", i + shift) for i in range(60)}
    return sorted(rows)


def _counts(rows):
    held = {}
    for u, i in rows:
        held.setdefault(u, []).append(i)
    return Counter((i, j) for h in held.values() if len(h) > 1 for i in h for j in h if i != j)


@pytest.mark.parametrize("kind,shift", [("int", 0), ("int", -30), ("bigint", 1 << 45), ("string", 0)])
@pytest.mark.parametrize("step,block", [(4_000_000, 4096), (300, 4096), (300, 7), (1, 5)])
def test_counts_with_hot_items_and_cut_histories(spark, monkeypatch, kind, shift, step, block):
    monkeypatch.setattr(pair_counts, "STEP_PAIRS", step)
    rows = _rows(shift)
    df = spark.createDataFrame([(u, i, 1) for u, i in rows] + [(None, 1 + shift, 1), ("u1", None, 1)],
                               "user_id string, item bigint, pref int").selectExpr(
        "user_id", f"cast(item as {kind}) item", "pref")
    got = cooccurrence(df, RecConfig(block_size=block))
    assert dict(got.dtypes)["i"] == kind and dict(got.dtypes)["c"] == "bigint"
    got = got.where("i is not null and j is not null").collect()
    assert {(int(r.i), int(r.j)): r.c for r in got} == _counts(rows) and len(got) == len(_counts(rows))


def test_no_pair_is_shuffled_before_it_is_counted(spark, tmp_path):
    """Lists are cut where their pairs are counted: of 300 x 299 pairs no more
    than the best leave the counting stage."""
    df = spark.createDataFrame([(f"u{i % 7}", i, 1) for i in range(300)]
                               + [("all", i, 1) for i in range(300)],
                               "user_id string, item int, pref int")
    from itemwise.plans.similarity import cosine_similarity
    assert cosine_similarity(df, RecConfig(), best=4).count() == 300 * 4
    assert item_similarity(df, RecConfig(top_n=4)).count() == 300 * 4


def test_far_apart_ids(spark):
    ids = [-(1 << 62), 5, (1 << 62) + 1]
    df = spark.createDataFrame([("u", i, 1) for i in ids] + [("v", i, 1) for i in ids[:2]],
                               "user_id string, item bigint, pref int")
    got = {(r.i, r.j): r.c for r in cooccurrence(df, RecConfig()).collect()}
    assert got == _counts([("u", i) for i in ids] + [("v", i) for i in ids[:2]])


def test_candidates_are_shuffled_once(spark):
    """Scores, distinct candidates and watched items come out of one
    aggregation: all candidates are not joined with the history again."""
    from itemwise.operators import score_candidate_side
    from itemwise.session import materialize

    df = materialize(spark.createDataFrame([(u, i, 1) for u, i in _rows()] + [(None, 1, 2)],
                                           "user_id string, item int, pref int"))
    sim = materialize(item_similarity(df, RecConfig(top_n=3)))
    for limit in (0, 3, 100):
        scored = score_candidate_side(df, sim, reverse_limit=limit)
        rows = {(r.user_id, r.item) for r in scored.collect()}
        held = {(u, i) for u, i in _rows()}
        lists = {(r.i, r.j) for r in sim.collect()}
        assert rows == ({(u, j) for u, i in held for a, j in lists if a == i} - held) | {
            (None, j) for a, j in lists if a == 1}
        plan = scored._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("LeftAnti") == 1
        anti = plan[plan.index("LeftAnti"):]
        assert "LeftSemi" in anti       # only candidates with an item of many lists
