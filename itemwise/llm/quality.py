"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature of a text is cut into at most ``BINS`` bins. Boosting goes round
the features in turn; each turn fits a shallow tree to the gradients of one
feature's bins and adds it, shrunk, to that feature's lookup table. The pairs
of features that explain most of what is left get two-dimensional tables in
the same way. A score is the logistic function of a sum of table entries:
one vectorised addition per table.

The model is fitted on a bounded sample: at most ``MAX_LABELLED`` labelled
rows, the first in a seeded order. Features come from the text alone. Scoring
is one pass over whole texts without a shuffle.

Contract: null text counts as empty and gets a score as any other; labels
that are null or belong to no document are not used; without labels of both
kinds the score is the smoothed share of label 1. Every input row returns
once; an empty table returns none; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemwise.llm.common import fresh, plain
from itemwise.llm.tokens import in_slices

MAX_LABELLED, BINS, PAIR_BINS, ROUNDS, PAIR_ROUNDS = 20_000, 32, 8, 150, 60
RATE, PAIRS, THRESHOLD, SMOOTH = 0.1, 8, 0.7, 1.0

FEATURES = ["words", "word_length", "word_spread", "distinct", "commonest", "upper", "digits",
            "marks", "symbols", "ends", "no_letter", "lines", "line_words", "line_copies",
            "short", "pairs", "doubled", "wide", "capitals", "commas", "longest", "bare_lines",
            "stops", "lower_start"]

_CLASS = np.zeros(256, dtype=np.int64)
_CLASS[list(range(65, 91))] = 1
_CLASS[list(range(97, 123))] = 2
_CLASS[list(range(48, 58))] = 3
_CLASS[[9, 10, 11, 12, 13, 32]] = 4
_CLASS[[ord(c) for c in ".,;:!?'\"-()"]] = 5
_CLASS[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]] = 6
_CLASS[128:] = 7


def features(text: str | None) -> list[float]:
    """The features of one whole text, in the order of FEATURES."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    kinds = np.bincount(_CLASS[np.frombuffer(raw, dtype=np.uint8)], minlength=8)
    words = text.split()
    n, chars = len(words), max(len(raw), 1)
    if not n:
        return [0.0] * len(FEATURES)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
    seen: dict[str, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    lines = [x for x in text.split("\n") if x.strip()]
    letters = max(int(kinds[1] + kinds[2] + kinds[7]), 1)
    return [
        float(np.log1p(n)), float(lengths.mean()), float(lengths.std()), len(seen) / n ** 0.75,
        max(seen.values()) / n, kinds[1] / letters, kinds[3] / chars, kinds[5] / chars,
        kinds[6] / chars, sum(w[-1] in ".!?" for w in words) / n,
        sum(not any(map(str.isalnum, w)) for w in words) / n, len(lines) / n,
        n / max(len(lines), 1), 1 - len(set(lines)) / max(len(lines), 1),
        float((lengths <= 3).mean()),
        len(set(zip(words, words[1:], strict=False))) / max(n - 1, 1),
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / n, kinds[7] / letters,
        sum(w[0].isupper() for w in words) / n, raw.count(b",") / chars,
        float(np.log1p(lengths.max())),
        sum(x.rstrip()[-1:] not in ".!?" for x in lines) / max(len(lines), 1),
        sum(c for w, c in seen.items() if c > 1 and len(w) <= 4) / n,
        float(words[0][:1].islower()),
    ]


@dataclass
class Model:
    """Edges and lookup tables; ``pairs`` holds (feature, feature, table)."""

    base: float
    edges: list[np.ndarray] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for j, table in enumerate(self.tables):
            total += table[np.searchsorted(self.edges[j], x[:, j], side="right")]
        for a, b, table in self.pairs:
            total += table[np.searchsorted(self.pair_edges[a], x[:, a], side="right"),
                           np.searchsorted(self.pair_edges[b], x[:, b], side="right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _leaf(g: float, h: float) -> float:
    return g / (h + SMOOTH)


def _split(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Best cut of a run of bins: gain and first bin of the right side."""
    if len(g) < 2:
        return 0.0, 0
    cg, ch = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    tg, th = g.sum(), h.sum()
    gain = cg ** 2 / (ch + SMOOTH) + (tg - cg) ** 2 / (th - ch + SMOOTH) - tg ** 2 / (th + SMOOTH)
    at = int(np.argmax(gain))
    return float(gain[at]), at + 1


def _tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Values of a shallow tree over one feature's bins."""
    gain, at = _split(g, h) if depth else (0.0, 0)
    if gain <= 1e-12:
        return np.full(len(g), _leaf(g.sum(), h.sum()))
    return np.concatenate([_tree(g[:at], h[:at], depth - 1), _tree(g[at:], h[at:], depth - 1)])


def _tree2(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Values of a shallow tree over the cells of two features."""
    rows, cols = _split(g.sum(1), h.sum(1)), _split(g.sum(0), h.sum(0))
    if not depth or max(rows[0], cols[0]) <= 1e-12:
        return np.full(g.shape, _leaf(g.sum(), h.sum()))
    if rows[0] >= cols[0]:
        at = rows[1]
        return np.concatenate([_tree2(g[:at], h[:at], depth - 1),
                               _tree2(g[at:], h[at:], depth - 1)])
    at = cols[1]
    return np.concatenate([_tree2(g[:, :at], h[:, :at], depth - 1),
                           _tree2(g[:, at:], h[:, at:], depth - 1)], axis=1)


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Cyclic boosting on a bounded matrix; the same data give the same model."""
    p = (y.sum() + 1) / (len(y) + 2)
    model = Model(float(np.log(p / (1 - p))))
    if len(y) < 2 or y.min() == y.max():
        return model
    m = x.shape[1]
    model.edges = [_edges(x[:, j], BINS) for j in range(m)]
    model.pair_edges = [_edges(x[:, j], PAIR_BINS) for j in range(m)]
    bins = [np.searchsorted(model.edges[j], x[:, j], side="right") for j in range(m)]
    coarse = [np.searchsorted(model.pair_edges[j], x[:, j], side="right") for j in range(m)]
    sizes = [len(e) + 1 for e in model.edges]
    wide = [len(e) + 1 for e in model.pair_edges]
    model.tables = [np.zeros(s) for s in sizes]
    total = np.full(len(y), model.base)

    def slopes():
        s = 1 / (1 + np.exp(-total))
        return y - s, s * (1 - s)

    for _ in range(ROUNDS):
        for j in range(m):
            g, h = slopes()
            add = RATE * _tree(np.bincount(bins[j], g, sizes[j]), np.bincount(bins[j], h, sizes[j]))
            model.tables[j] += add
            total += add[bins[j]]

    def cells(a: int, b: int, g, h):
        key, shape = coarse[a] * wide[b] + coarse[b], (wide[a], wide[b])
        n = shape[0] * shape[1]
        return np.bincount(key, g, n).reshape(shape), np.bincount(key, h, n).reshape(shape), key

    g, h = slopes()
    gains = []
    for a in range(m):
        for b in range(a + 1, m):
            cg, ch, _ = cells(a, b, g, h)
            v = _tree2(cg, ch)
            gains.append((float((v * cg - v * v * ch / 2).sum()), -a, -b))
    chosen = [(-a, -b) for _, a, b in sorted(gains, reverse=True)[:PAIRS]]
    model.pairs = [(a, b, np.zeros((wide[a], wide[b]))) for a, b in chosen]
    for _ in range(PAIR_ROUNDS):
        for a, b, table in model.pairs:
            g, h = slopes()
            cg, ch, key = cells(a, b, g, h)
            add = RATE * _tree2(cg, ch)
            table += add
            total += add.reshape(-1)[key]
    return model


def held_out(doc_id):
    return (F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 4) == 2


def _matrix(part) -> np.ndarray:
    return np.array([features(t) for t in part.column("text").to_pylist()],
                    dtype=float).reshape(-1, len(FEATURES))


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Model:
    """Fit on at most ``max_labelled`` labelled documents outside the held-out fold."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                           F.col("quality").cast("int").alias("quality"))
             .where("doc_id is not null and quality is not null").where(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("quality").alias("quality"))
             .orderBy(F.xxhash64("doc_id", F.lit(11)), "doc_id").limit(max_labelled))

    def run(batches):
        for batch in batches:
            for part in in_slices(batch):
                rows = pa.array(list(_matrix(part)), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("quality"),
                                                  rows], names=["doc_id", "quality", "x"])

    # bounded by max_labelled rows of numbers, also where ids repeat
    rows = (plain(docs).join(F.broadcast(known), "doc_id")
            .mapInArrow(run, "doc_id long, quality int, x array<double>")
            .orderBy("doc_id", F.xxhash64("x")).limit(max_labelled).toPandas())
    if not len(rows):
        return fit(np.zeros((0, len(FEATURES))), np.zeros(0))
    return fit(np.array(rows["x"].tolist()), (rows["quality"].to_numpy() > 0).astype(float))


def score(docs: DataFrame, model: Model, column: str = "_score") -> DataFrame:
    """``docs`` with a new column ``column``, which they must not have yet; all
    other columns pass through, whatever their names."""
    text_name, = fresh(docs, "_text")
    named = docs.withColumn(text_name, F.col("text").cast("string"))

    @F.pandas_udf("double")
    def scored(text: pd.Series) -> pd.Series:
        x = np.array([features(t) for t in text], dtype=float).reshape(-1, len(FEATURES))
        return pd.Series(model.score(x))

    return named.withColumn(column, scored(text_name)).drop(text_name)


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
                   max_labelled: int = MAX_LABELLED) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    model = train(docs, labels, max_labelled)
    return score(plain(docs), model).select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= threshold).cast("int").alias("predicted"))
