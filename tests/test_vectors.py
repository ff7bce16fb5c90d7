"""Exact top-K cosine search against numpy brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from itemwise import vector_topk
from itemwise.functions import cosine, dot, norm
from itemwise.sources import fixtures as fx


def _brute(rows, k):
    ids = np.array([r.vec_id for r in rows])
    mat = np.array([r.embedding for r in rows], dtype=np.float64)
    unit = mat / np.linalg.norm(mat, axis=1, keepdims=True)
    sims = np.round(unit @ unit.T, 6)
    out = set()
    for a in range(len(ids)):
        order = sorted((-sims[a, b], ids[b]) for b in range(len(ids)) if b != a)[:k]
        out |= {(int(ids[a]), int(nb), round(-s, 6), rk + 1) for rk, (s, nb) in enumerate(order)}
    return out


@pytest.mark.parametrize("block_rows,chunk_rows", [(8192, 1024), (64, 5), (7, 2)])
def test_vector_topk_matches_brute_force(spark, block_rows, chunk_rows):
    emb = fx.embeddings(spark, SF_SMALL).where(F.col("vec_id") < 150)
    want = _brute(emb.collect(), 5)
    got = {(r.vec_id, r.nbr_id, round(r.sim, 6), r.rk)
           for r in vector_topk(emb, "vec_id", "embedding", 5, block_rows=block_rows,
                                       chunk_rows=chunk_rows).collect()}
    assert got == want


def test_column_functions(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0]), ([1.0, 0.0], [0.0, 0.0])],
                               "a array<double>, b array<double>")
    rows = df.select(dot("a", "b").alias("d"), norm("a").alias("n"),
                     cosine("a", "b").alias("c")).collect()
    assert rows[0].d == 24.0 and rows[0].n == 5.0 and abs(rows[0].c - 0.96) < 1e-12
    assert rows[1].c is None                     # zero vector: no defined cosine


def _coarse(rows, k, decimals):
    import numpy as np

    out = set()
    for i, v in rows:
        scored = []
        for j, w in rows:
            if i != j:
                sim = float(np.dot(v, w) / (np.linalg.norm(v) * np.linalg.norm(w)))
                scored.append((-np.floor(sim * 10 ** decimals + 0.5) / 10 ** decimals, j))
        out |= {(i, j) for _, j in sorted(scored)[:k]}
    return out


def test_few_vectors_and_coarse_rounding(spark):
    """Blocks may be empty, scores may tie: k neighbours each, by id."""
    import numpy as np
    from itemwise.operators.vector_search import vector_topk

    rng = np.random.default_rng(5)
    for n, decimals in ((1, 6), (2, 6), (3, 2), (5, 6), (60, 1), (60, 2)):
        rows = [(i, rng.random(4).tolist()) for i in range(n)]
        df = spark.createDataFrame(rows, "id long, v array<double>")
        got = {(r.id, r.nbr_id) for r in vector_topk(df, "id", "v", 3, decimals=decimals).collect()}
        assert got == _coarse(rows, 3, decimals), (n, decimals)


def test_equal_vectors_give_k_rows_each(spark):
    from itemwise.operators.vector_search import vector_topk

    df = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(200)], "id long, v array<double>")
    rows = vector_topk(df, "id", "v", 3).collect()
    assert len(rows) == 600
    assert {r.nbr_id for r in rows if r.id > 3} == {0, 1, 2}


def _groups(n, groups, dim=16, seed=3):
    """Vectors around a few directions, with repeated ones, zero, null and
    vectors that hold no number."""
    import numpy as np

    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dim))
    rows = [(i, (centres[i % groups] * 5 + rng.normal(size=dim) * 0.3).tolist()) for i in range(n)]
    rows += [(n, rows[0][1]), (n + 1, rows[0][1]), (n + 2, [0.0] * dim), (n + 3, None),
             (n + 4, [float("nan")] * dim)]
    return rows


@pytest.mark.parametrize("n,groups,block_rows,decimals", [
    (400, 6, 20, 6), (300, 1, 32, 6), (300, 3, 40, 1), (7, 2, 100, 6), (2, 1, 1, 6)])
def test_pruned_search_matches_brute_force(spark, n, groups, block_rows, decimals):
    from itemwise.operators import vector_topk_pruned

    rows = _groups(n, groups)
    df = spark.createDataFrame(rows, "id long, v array<double>")
    got = vector_topk_pruned(df, "id", "v", 5, block_rows=block_rows, decimals=decimals,
                             chunk_rows=16).collect()
    plain = [(i, v) for i, v in rows if v is not None and any(v) and v[0] == v[0]]
    assert {(r.id, r.nbr_id) for r in got} == _coarse(plain, 5, decimals)
    assert all(1 <= r.rk <= 5 for r in got)


def test_pruned_search_scores_few_pairs_of_grouped_vectors(spark):
    from itemwise.operators import PrunedSearch

    df = spark.createDataFrame(_groups(2000, 12), "id long, v array<double>")
    search = PrunedSearch(df, "id", "v", 5, block_rows=100)
    cost = search.cost().first()
    assert cost.vectors == 2002
    assert cost.copies / cost.vectors < cost.blocks / 4      # all pairs: one copy per block
    assert cost.scored < cost.all_pairs / 4
    assert search.top().count() == 2002 * 5


def test_many_vectors_are_searched_by_bounds(spark):
    emb = fx.embeddings(spark, SF_SMALL).where(F.col("vec_id") < 150)
    a = vector_topk(emb, "vec_id", "embedding", 5)
    b = vector_topk(emb, "vec_id", "embedding", 5, block_rows=32, all_pairs_rows=100)
    key = lambda r: (r.vec_id, r.rk, r.nbr_id, r.sim)
    assert sorted(map(key, a.collect())) == sorted(map(key, b.collect()))


@pytest.mark.parametrize("rows", [[], [(1, [0.0, 0.0])], [(1, [1.0, 2.0])]])
def test_pruned_search_of_hardly_any_vector(spark, rows):
    from itemwise.operators import vector_topk_pruned

    df = spark.createDataFrame(rows, "id long, v array<double>")
    assert vector_topk_pruned(df, "id", "v", 3).count() == 0


def test_pruned_search_of_bundles_and_slices(spark, monkeypatch):
    """Bundles of several groups, groups of several bundles and sliced
    questions give every neighbour."""
    from itemwise.operators import vector_pruning, vector_topk_pruned

    rows = _groups(300, 4)
    df = spark.createDataFrame(rows, "id long, v array<double>")
    plain = _coarse([(i, v) for i, v in rows if v is not None and any(v) and v[0] == v[0]], 5, 6)
    for bundle, slice_rows, held in ((1000, 1000, 1 << 20), (40, 25, 50), (5, 7, 1)):
        monkeypatch.setattr(vector_pruning, "BUNDLE_ROWS", bundle)
        monkeypatch.setattr(vector_pruning, "SLICE_ROWS", slice_rows)
        monkeypatch.setattr(vector_pruning, "_ANGLES_HELD", held)
        got = vector_topk_pruned(df, "id", "v", 5, block_rows=20, chunk_rows=16).collect()
        assert {(r.id, r.nbr_id) for r in got} == plain and len(got) == len(plain)


def test_asking_a_group_copies_no_vector(spark):
    """One row per vector leaves the search for groups to ask, however many
    they are (before: one per group, with the vector)."""
    from itemwise.operators import PrunedSearch

    df = spark.createDataFrame(_groups(400, 1), "id long, v array<double>")
    search = PrunedSearch(df, "id", "v", 5, block_rows=20)
    assert search.cost().first().copies > 402
    assert search.asked.count() == 402


def test_best_rows_of_wide_blocks():
    import numpy as np
    from itemwise.operators import vector_search as vs

    rng = np.random.default_rng(1)
    for decimals in (1, 2, 6):
        scores = rng.normal(size=(40, 700))
        scores[3, :] = np.nan
        scores[4, :650] = np.nan
        scores[5, :] = 0.5
        got = vs._best(scores, np.arange(40), np.arange(700), 10, decimals)
        for r in range(40):
            ok = np.flatnonzero(~np.isnan(scores[r]))
            rounded = vs._rounded(scores[r, ok], decimals)
            want = [int(ok[i]) for i in np.lexsort((ok, -rounded))[:10]]
            assert sorted(got[got.src == r].nbr) == sorted(want)
