"""Exact top-k search by a Voronoi join.

Vectors are grouped by their nearest pivot. A group's summary (pivot, number
of rows, radius) bounds every inner product with one of its vectors:
<q, v> <= <q, pivot> + |q| * radius. A query is first solved against its own
group, which gives it a score to beat; then it is sent only to the groups
whose bound reaches that score, and solved there. Groups are dealt into
blocks of about ``BLOCK`` rows by a hash, and queries into blocks as well, so
no task grows with a group; each task returns k rows per query at most.

Pivots are a bounded sample (``PIVOTS`` distinct vectors in a seeded order);
they steer the grouping only, every row is searched and the result is exact.

Contract: components become floor(256 * x), x as double. Vectors that are
null or hold null, NaN or infinite components take no part, nor do rows with
a null vec_id; a shorter vector counts as padded with zeros. A query's own
rows (same vec_id) are no candidates for it; each query row returns its own
list. Ties go to the smaller vec_id. An empty table returns none.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from itemwise.llm.common import stage

PIVOTS, BLOCK, SCALE = 64, 8192, 256


def _matrix(vectors, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _scores(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Integer inner products. A float64 product of integers is exact while
    sums stay below 2^53; beyond, Python integers are used."""
    top = (np.abs(q).max(initial=0) * np.abs(v).max(initial=0)) * max(q.shape[1], 1)
    if top < 2 ** 53:
        return (q @ v.T).astype(np.int64)
    exact = [[int(x) for x in row] for row in v]
    return np.array([[sum(int(a) * b for a, b in zip(row, other, strict=True)) for other in exact]
                     for row in q], dtype=object).astype(np.int64)


def _local(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best rows of one block for each query of one block."""
    cols = ["query_row", "query_id", "vec_id", "score"]
    if not len(queries) or not len(rows):
        return pd.DataFrame({c: pd.Series(dtype="int64") for c in cols})
    rows = rows.sort_values(["vec_id", "row"])
    width = max(rows["v"].map(len).max(), queries["v"].map(len).max())
    v, ids = _matrix(rows["v"].tolist(), width), rows["vec_id"].to_numpy()
    out = []
    for at in range(0, len(queries), 256):
        part = queries.iloc[at: at + 256]
        scores = _scores(_matrix(part["v"].tolist(), width), v)
        for s, qrow, qid in zip(scores, part["row"], part["vec_id"], strict=True):
            free = np.flatnonzero(ids != qid)
            got = s[free]
            if len(got) > k:
                edge = np.partition(got, len(got) - k)[len(got) - k]
                above = np.flatnonzero(got > edge)
                # rows come by vec_id, so the first ties are the smallest ids
                keep = np.concatenate([above, np.flatnonzero(got == edge)[: k - len(above)]])
                free, got = free[keep], got[keep]
            out += [(qrow, qid, ids[f], x) for f, x in zip(free, got, strict=True)]
    return pd.DataFrame(out, columns=cols).astype("int64")


def _solve(queries: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """Both sides carry cell, chunk and query block."""
    keys = ["cell", "chunk", "qb"]

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return _local(left, right, k)

    return queries.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInPandas(
        run, "query_row long, query_id long, vec_id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def voronoi_knn(embeddings: DataFrame, is_query, k: int = 5, pivots: int = PIVOTS,
                block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score of the k highest scores of each query
    row; ``is_query`` is a condition on vec_id."""
    good = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x)
                    & (F.abs(x) < F.lit(float("inf"))))
    x = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"),
                          F.col("embedding").cast("array<double>").alias("embedding"))
    ints = F.transform("embedding", lambda c: F.floor(c * SCALE).cast("double"))
    vectors = stage(x.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & good)
                    .select("vec_id", ints.alias("v"), is_query.alias("is_query"))
                    .withColumn("row", F.monotonically_increasing_id()), "vectors").df
    n = vectors.count()
    # bounded by PIVOTS rows, chosen alike in every run
    sample = vectors.select("v").distinct().orderBy(F.xxhash64("v"), "v").limit(pivots).collect()
    width = max((len(r.v) for r in sample), default=0)
    centre = _matrix([r.v for r in sample], width)

    def group(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            v = batch.column("v").to_pylist()
            wide = max(width, max(map(len, v)))
            m, c = _matrix(v, wide), np.pad(centre, ((0, 0), (0, wide - width)))
            square = (m * m).sum(1)[:, None] - 2 * m @ c.T + (c * c).sum(1)[None]
            cell = square.argmin(1)
            far = np.linalg.norm(m - c[cell], axis=1)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(x) for x in ("vec_id", "v", "is_query", "row")],
                 pa.array(cell.astype(np.int32)), pa.array(far)],
                names=["vec_id", "v", "is_query", "row", "cell", "far"])

    grouped = stage(vectors.mapInArrow(
        group, "vec_id long, v array<double>, is_query boolean, row long, cell int, far double"),
        "voronoi").df
    # one summary per pivot
    summary = grouped.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("radius"),
                                          F.max(F.size("v")).alias("width")).collect()
    chunks = {r.cell: math.ceil(r.n / block) for r in summary}
    radius = {r.cell: r.radius for r in summary}
    blocks = max(1, math.ceil(grouped.where("is_query").count() / block))
    spans = F.create_map(*[F.lit(a) for r in summary for a in (r.cell, chunks[r.cell])]) \
        if summary else F.create_map().cast("map<int,int>")
    rows = grouped.withColumn("chunk", F.pmod(F.xxhash64("row"), spans[F.col("cell")]).cast("int"))
    rows = rows.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    queries = grouped.where("is_query").withColumn(
        "qb", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(blocks)).cast("int"))
    all_chunks = F.explode(F.sequence(F.lit(0), spans[F.col("cell")] - 1))
    own = queries.withColumn("chunk", all_chunks)
    first = stage(_best(_solve(own, rows, k), k).drop("rank"), "own-cell").df
    edge = first.groupBy("query_row").agg(
        F.when(F.count("*") >= k, F.min("score")).alias("edge"))
    asked = queries.join(edge.withColumnRenamed("query_row", "row"), "row", "left")

    def reach(batches):
        for batch in batches:
            v = batch.column("v").to_pylist()
            if not v:
                continue
            wide = max(width, max(map(len, v)))
            m, c = _matrix(v, wide), np.pad(centre, ((0, 0), (0, wide - width)))
            bound = m @ c.T + np.linalg.norm(m, axis=1)[:, None] * np.array(
                [radius.get(i, 0.0) for i in range(len(c))])[None]
            edges = np.array([-np.inf if e is None else e for e in
                              batch.column("edge").to_pylist()])
            # a margin for rounding, relative to the bound
            open_ = bound + 1e-6 * (1 + np.abs(bound)) >= edges[:, None]
            cells = [[j for j in np.flatnonzero(o).tolist() if j != own_cell and j in radius]
                     for o, own_cell in zip(open_, batch.column("cell").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(x) for x in ("vec_id", "v", "row", "qb")],
                 pa.array(cells, pa.list_(pa.int32()))],
                names=["vec_id", "v", "row", "qb", "cells"])

    sent = (asked.mapInArrow(reach, "vec_id long, v array<double>, row long, qb int, "
                             "cells array<int>")
            .withColumn("cell", F.explode("cells")).drop("cells")
            .withColumn("chunk", all_chunks))
    found = first.unionByName(_solve(sent, rows, k))
    if n == 0:
        found = found.limit(0)
    return _best(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id",
                                  "score")
