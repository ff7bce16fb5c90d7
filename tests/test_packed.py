"""Lists go to their users as compressed blocks, and written tables leave no
shuffle files."""

import os
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from itemwise.operators import (candidates, packed, recommend as operators, score_candidate_side,
                                score_source_side, unseen_candidates)
from itemwise.session import materialize


def _case(item=int, user=str):
    rng = random.Random(11)
    hist = {("u0", m): rng.randint(1, 9) for m in range(60)}
    hist |= {(rng.choice(["u1", "ü2", "", None]), rng.randrange(80)): rng.choice([None, 1, 2, 7])
             for _ in range(70)}
    sim = {(i, j): rng.randint(1, 8) / 8 for i in range(90) for j in rng.sample(range(90), 4)
           if i != j}
    name = {"u0": 5, "u1": 1 << 40, "ü2": -3, "": 0, None: None} if user is int else None
    of = (lambda u: name[u]) if name else (lambda u: u)
    return ({(of(u), item(i)): p for (u, i), p in hist.items()},
            {(item(i), item(j)): s for (i, j), s in sim.items()})


def _expected(hist, sim):
    cand = {(u, j) for u, m in hist for i, j in sim if i == m}
    unseen = {(u, c) for u, c in cand if u is None or (u, c) not in hist}
    source, own = {}, dict.fromkeys(unseen, 0.0)
    for (u, m), p in hist.items():
        for (i, j), s in sim.items():
            if p is not None and i == m and (u, j) in unseen:
                source[u, j] = source.get((u, j), 0) + p * s
            if p is not None and j == m and (u, i) in unseen:
                own[u, i] += p * s
    return cand, unseen, {k: source.get(k) for k in unseen}, own


@pytest.mark.parametrize("terms,held,step", [(10**6, 10**6, 10**6), (90, 200, 50)])
@pytest.mark.parametrize("kind,item,user", [
    ("int", int, str), ("bigint", lambda i: (i - 30) << 40, int), ("string", str, str)])
def test_packed_against_plain_python(spark, monkeypatch, kind, item, user, terms, held, step):
    """Null users and preferences, far ids and text; with 90 entries a task u0
    and the rows without a user are heavy."""
    monkeypatch.setattr(operators, "PLAIN_TERMS", 0)
    monkeypatch.setattr(operators, "TASK_TERMS", terms)
    monkeypatch.setattr(packed, "HELD_ENTRIES", held)
    monkeypatch.setattr(packed, "STEP_ENTRIES", step)
    hist, sim = _case(item, user)
    h = spark.createDataFrame([(*k, p) for k, p in hist.items()], "user_id "
                              f"{'bigint' if user is int else 'string'}, item {kind}, pref int")
    s = spark.createDataFrame([(*k, x) for k, x in sim.items()], f"i {kind}, j {kind}, sim double")
    cand, unseen, source, own = _expected(hist, sim)
    for frame, expected in ((candidates(h, s), cand), (unseen_candidates(h, s), unseen)):
        got = [(r.user_id, r.item) for r in frame.collect()]
        assert len(got) == len(expected) and set(got) == expected
    for frame, expected in ((score_source_side(h, s), source), (score_candidate_side(h, s), own)):
        assert frame.schema["item"].dataType == h.schema["item"].dataType
        got = frame.collect()
        assert len(got) == len(expected)
        got = {(r.user_id, r.item): r.score for r in got}
        assert {k for k, v in got.items() if v is None} == {
            k for k, v in expected.items() if v is None}
        assert {k: v for k, v in got.items() if v is not None} == pytest.approx(
            {k: v for k, v in expected.items() if v is not None})
    for frame, expected in ((score_source_side(h, s, best=3), source),
                            (score_candidate_side(h, s, best=3), own)):
        got, full = frame.collect(), {}
        for (u, c), v in expected.items():
            full.setdefault(u, []).append((-np.inf if v is None else round(v, 6), c))
        rows = {}
        for r in got:
            rows.setdefault(r.user_id, []).append((-np.inf if r.score is None else r.score, r.item))
        for u, found in full.items():
            first = sorted(found, key=lambda x: (-x[0], x[1]))[:3]
            assert sorted(rows[u], key=lambda x: (-x[0], x[1]))[:3] == first


def test_lists_are_packed(spark, monkeypatch):
    """What goes to users is a fraction of the lists as rows."""
    rng = np.random.default_rng(1)
    h = materialize(spark.createDataFrame(
        [(f"u{u}", int(i), 1) for u in range(400) for i in rng.choice(20_000, 20, False)],
        "user_id string, item int, pref int"))
    s = materialize(spark.range(20_000).select(
        F.col("id").cast("int").alias("i"), F.explode(F.sequence(F.lit(1), F.lit(10))).alias("k"))
        .select("i", F.pmod(F.xxhash64("i", "k"), F.lit(20_000)).cast("int").alias("j"),
                (1 / F.sqrt(1 + F.pmod(F.hash("i", "k"), F.lit(50)))).alias("sim")))
    monkeypatch.setattr(operators, "PLAIN_TERMS", 0)
    taken = []

    def take(rows, *_):
        taken.append(rows.select(F.lit(0).alias("bundle"), *packed.COLUMNS).toArrow())
        return rows.selectExpr("user_id", "items[0] item", "pref total")

    monkeypatch.setattr(operators, "summed_by_users", take)
    score_candidate_side(h, s)
    size = sum(b.nbytes for b in packed._blocks(taken[0].to_batches()))
    assert 5 * size < taken[0].nbytes


def test_written_tables_leave_no_shuffle_files(spark):
    before = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def size():
        names = disk.getAllFiles().mkString("\n").split("\n")
        return sum(os.path.getsize(f) for f in names if os.path.exists(f))

    start = size()
    table = materialize(spark.range(2_000_000).groupBy((F.col("id") * 7 % 1_000_003).alias("k"))
                        .agg(F.max("id").alias("m")))
    for _ in range(40):
        if size() <= start + 1_000_000:
            break
        time.sleep(0.5)
    assert size() <= start + 1_000_000 and table.count() == 1_000_003
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == before


@pytest.mark.parametrize("plain", [0, 10**9])
def test_wide_lists_are_met_by_some_users_at_a_time(spark, monkeypatch, plain):
    """The same scores in many passes, whose tables hold no more users than fit."""
    monkeypatch.setattr(operators, "PLAIN_TERMS", plain)
    hist, sim = _case()
    hist = {(u, i): p for (u, i), p in hist.items() if u is not None}
    h = spark.createDataFrame([(*k, p) for k, p in hist.items()], "user_id string, item int, pref int")
    s = spark.createDataFrame([(*k, x) for k, x in sim.items()], "i int, j int, sim double")
    _, _, _, own = _expected(hist, sim)
    for rows, least in ((10**6, 1), (40, 2)):
        monkeypatch.setattr(operators, "PASS_TERMS", rows)
        keep = []
        got = score_candidate_side(h, s, reverse_limit=3, keep=keep).collect()
        assert len(got) == len(own)
        assert {(r.user_id, r.item): r.score for r in got} == pytest.approx(own)
        passes = [t for t in keep if "wide-terms" in t._itemwise_path]
        assert (len(passes) > 1) == (least > 1)
        users = [{r.user_id for r in t.select("user_id").distinct().collect()} for t in passes]
        assert sum(map(len, users)) == len(set().union(*users))
