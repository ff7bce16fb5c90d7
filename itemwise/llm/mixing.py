"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by source and exact length. Each source gets a word
budget; whole copies of the source come first (a budget of its size or more
takes every document once), and the rest of the budget is fitted on the
length counts alone: an even share of every length, then the longest that
still fit, then a bounded-knapsack dynamic program over what is left. The
counts then select documents: of each length, the first in a seeded order.

Targets: sources by code point (null last) weigh 3, 1, 2, repeating, and
share 150 % of all words; a target stops at twice its source's size, and the
excess is shared again by weight: target = min(2 * size, level * weight) for
the one level at which all targets sum to the budget.

Contract: a document's size is its number of words (null: 0); a document of
size 0 takes nothing. Every input row returns once and reruns agree; of rows
with the same id and text any may be the one taken. An empty table returns
none; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from itemwise.llm.common import BLANKS, fresh, number, stage

WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2
#: Budget that the dynamic program covers; longer lengths are placed first.
DP_BUDGET = 1 << 16


def fit(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length (positive, distinct) to take so that
    their lengths sum to ``budget`` or as near below it as the method gets."""
    total = int((lengths * counts).sum())
    if budget >= total:
        return counts.copy()
    take = (counts * (max(budget, 0) / max(total, 1))).astype(np.int64)
    left = budget - int((take * lengths).sum())
    down = np.argsort(-lengths, kind="stable")
    for i in down:
        if left <= DP_BUDGET:
            break
        more = min(int(counts[i] - take[i]), (left - DP_BUDGET) // int(lengths[i]) + 1,
                   left // int(lengths[i]))
        take[i] += more
        left -= more * int(lengths[i])
    return take + _knapsack(lengths, counts - take, min(left, DP_BUDGET))


def _knapsack(lengths, counts, budget: int) -> np.ndarray:
    """Bounded subset sum nearest below ``budget``. Counts are split into
    powers of two; first[s] is the split that first reached sum s, and all
    splits below it reached the rest."""
    take = np.zeros(len(lengths), dtype=np.int64)
    reached = np.zeros(budget + 1, dtype=bool)
    reached[0] = True
    first = np.full(budget + 1, -1, dtype=np.int64)
    splits: list[tuple[int, int]] = []
    for i in np.argsort(-lengths, kind="stable"):
        rest, power = min(int(counts[i]), budget // int(lengths[i])), 1
        while rest > 0 and not reached[budget]:
            m = min(power, rest)
            rest, power = rest - m, power * 2
            w = m * int(lengths[i])
            new = np.zeros(budget + 1, dtype=bool)
            new[w:] = reached[: budget + 1 - w]
            new &= ~reached
            first[new] = len(splits)
            reached |= new
            splits.append((i, m))
        if reached[budget]:
            break
    s = int(np.flatnonzero(reached)[-1])
    while s > 0:
        i, m = splits[first[s]]
        take[i] += m
        s -= m * int(lengths[i])
    return take


def targets(sources: DataFrame, share: float = SHARE) -> DataFrame:
    """``sources`` (written: source, weight, source_size) with their targets."""
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    budget, level = share * total, 0.0
    cap = MOST * F.col("source_size")
    while True:  # the level only rises, and each round fixes at least one more source
        full = cap <= F.lit(level) * F.col("weight")
        got = sources.agg(F.sum(F.when(full, cap).otherwise(0)).alias("fixed"),
                          F.sum(F.when(full, 0).otherwise(F.col("weight"))).alias("open")).first()
        after = (budget - got.fixed) / got.open if got.open else level
        if after <= level:
            break
        level = after
    return sources.withColumn("target", F.least(
        cap.cast("double"), F.lit(float(level)) * F.col("weight")))


def _ranked(table: DataFrame, order: list) -> DataFrame:
    """Global rank ``n`` by a range-partitioned sort: positions inside each
    partition, shifted by the sizes of the partitions before."""
    rows = stage(table.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()),
                 "sorted").df
    part = F.shiftright("_at", 33)
    sizes = rows.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return (rows.withColumn("_part", part).join(starts, "_part")
            .withColumn("n", F.col("_start") + F.col("_at").bitwiseAND((1 << 33) - 1))
            .drop("_at", "_part", "_start"))


def mix(docs: DataFrame, seed: int = 7, share: float = SHARE,
        row: str | None = None) -> DataFrame:
    """doc_id, text_md5, source, size, source_size, target, taken, copies, and
    ``row_id``: column ``row`` of ``docs``, if one is named."""
    carried = [F.col(row).alias("row_id")] if row else []
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = stage(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.md5(text).alias("text_md5"),
        F.col("source").cast("string").alias("source"),
        F.regexp_count(text, F.lit(f"[^{BLANKS}]+")).cast("long").alias("size"), *carried),
        "sizes").df
    lengths = stage(rows.groupBy("source", "size").agg(F.count("*").alias("docs")),
                    "length-counts").df
    by_source = lengths.groupBy("source").agg(
        F.sum(F.col("size") * F.col("docs")).alias("source_size"))
    ranked = _ranked(by_source, [F.col("source").asc_nulls_last()])
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]),
                          (F.col("n") % len(WEIGHTS) + 1).cast("int"))
    sources = stage(ranked.select("source", "source_size", weight.alias("weight")), "sources").df
    wanted = stage(targets(sources, share), "targets").df

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        # one row per distinct length of a source
        size, n = pdf["size"].to_numpy(), pdf["docs"].to_numpy()
        whole, goal = int(pdf["source_size"].iloc[0]), round(float(pdf["target"].iloc[0]))
        once = int(goal >= whole)
        extra = np.zeros(len(pdf), dtype=np.int64)
        some = size > 0
        extra[some] = fit(size[some], n[some], goal - once * whole)
        return pd.DataFrame({"source": pdf["source"], "size": size, "once": once, "extra": extra,
                             "source_size": whole, "target": pdf["target"]})

    joined = lengths.alias("l").join(wanted.alias("r"), F.col("l.source").eqNullSafe(
        F.col("r.source"))).select("l.source", "l.size", "l.docs", "r.source_size", "r.target")
    chosen = stage(joined.groupBy("source").applyInPandas(
        choose, "source string, size long, once long, extra long, source_size long, "
        "target double"), "chosen").df
    numbered = stage(number(rows, ["source", "size"], ["doc_id", "text_md5"], "at", seed),
                     "ranked").df
    both = numbered.alias("l").join(
        chosen.alias("r"), F.col("l.source").eqNullSafe(F.col("r.source"))
        & (F.col("l.size") == F.col("r.size")))
    copies = F.when(F.col("l.size") == 0, 0).otherwise(
        F.col("r.once") + (F.col("l.at") < F.col("r.extra")).cast("long"))
    return (both.select("l.doc_id", "l.text_md5", "l.source", "l.size", "r.source_size",
                        "r.target", copies.cast("long").alias("copies"),
                        *(["l.row_id"] if row else []))
            .withColumn("taken", F.col("copies") * F.col("size")))


def mixed_documents(docs: DataFrame, seed: int = 7) -> DataFrame:
    """``docs`` as the mix takes them: a document taken twice stands twice; a
    document without words is no part of any budget and stays once. Every row
    has its own share of the plan, also where id and text repeat. All columns
    pass through, whatever their names."""
    row, copies, copy = fresh(docs, "_row", "_copies", "_copy")
    numbered = stage(docs.withColumn(row, F.monotonically_increasing_id()), "mix-rows").df
    plan = stage(mix(numbered, seed, row=row).select(
        F.col("row_id").alias(row),
        F.when(F.col("size") == 0, 1).otherwise(F.col("copies")).alias(copies)), "mix-plan").df
    return (numbered.join(plan.where(F.col(copies) > 0), row)
            .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
