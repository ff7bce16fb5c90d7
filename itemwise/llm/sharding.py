"""Shards of nearly equal bytes by Karmarkar-Karp differencing.

Groups of equal texts are indivisible. A partial partition is a vector of k
sums; differencing repeatedly takes the two with the largest spread and adds
them in opposite order, largest onto smallest, until one is left.

One heap over all groups would not scale, so the same step runs in levels:
groups are dealt into bundles of ``BUNDLE`` by a hash, each bundle is
differenced into ``PARTS`` nearly equal composites in its own task, and
composites are the indivisible items of the next level, until at most
``LAST`` items are left for the last differencing into shards. Items of at
least 1/(shards * ``HEAVY``) of all bytes skip the bundles, since a composite
could not make up for them; there are at most shards * HEAVY of those. Every
task is bounded, whatever the data.

Contract: size is the UTF-8 bytes of the text (null: none) plus 8. Null and
empty texts are one group. Every input row returns once, repeated rows too;
an empty table returns none; other columns are not read. Reruns agree.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemwise.llm.common import number, plain, stage

BUNDLE, PARTS, LAST, HEAVY = 2000, 64, 8000, 400


def difference(sizes, k: int) -> np.ndarray:
    """The part (0 to k-1, largest sum first) of each item."""
    n = len(sizes)
    part = np.zeros(n, dtype=np.int64)
    if n == 0 or k <= 1:
        return part
    sums: dict[int, np.ndarray] = {}
    heap = []
    for i, size in enumerate(sizes):
        sums[i] = np.zeros(k, dtype=np.int64)
        sums[i][0] = size
        heap.append((-int(size), i))
    heapq.heapify(heap)
    joins = []
    for new in range(n, 2 * n - 1):
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        both = sums.pop(a) + sums.pop(b)[::-1]
        order = np.argsort(-both, kind="stable")
        both = both[order]
        sums[new] = both
        joins.append((new, a, b, order))
        heapq.heappush(heap, (int(both[-1] - both[0]), new))
    final = {2 * n - 2: np.arange(k)}
    for new, a, b, order in reversed(joins):
        place = np.empty(k, dtype=np.int64)
        place[order] = final.pop(new)
        for child, at in ((a, place), (b, place[::-1])):
            if child < n:
                part[child] = at[0]
            else:
                final[child] = at
    return part


def _bundles(items: DataFrame, level: int, parts: int) -> DataFrame:
    """item, size, parent: the composite that holds the item."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "item"], ascending=[False, True])
        part = difference(pdf["size"].to_numpy(), parts)
        return pd.DataFrame({"item": pdf["item"], "size": pdf["size"],
                             "parent": [f"{level}:{pdf['bundle'].iloc[0]}:{p}" for p in part]})

    return items.groupBy("bundle").applyInPandas(run, "item string, size long, parent string")


def _last(items: DataFrame, shards: int) -> DataFrame:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "item"], ascending=[False, True])
        return pd.DataFrame({"item": pdf["item"],
                             "shard": difference(pdf["size"].to_numpy(), shards).astype("int32")})

    one = items.withColumn("one", F.lit(1))
    return one.groupBy("one").applyInPandas(run, "item string, shard int")


def assign(items: DataFrame, shards: int) -> DataFrame:
    """The shard of every item; ``items`` (item string, size long) is written."""
    total = items.agg(F.sum("size")).first()[0] or 0
    heavy = F.col("size") * (shards * HEAVY) >= F.lit(total)
    level, links, ready, light = 0, [], items.where(heavy), items.where(~heavy)
    n = light.count()
    while n > LAST:
        bundles = math.ceil(n / BUNDLE)
        dealt = light.withColumn("bundle", F.pmod(F.xxhash64("item"), F.lit(bundles)))
        links.append(stage(_bundles(dealt, level, PARTS), f"composites-{level}").df)
        parents = stage(links[-1].groupBy(F.col("parent").alias("item"))
                        .agg(F.sum("size").alias("size")), f"items-{level + 1}").df
        ready, light = ready.unionByName(parents.where(heavy)), parents.where(~heavy)
        n, level = light.count(), level + 1
    found = stage(_last(ready.unionByName(light), shards), "last-shards").df
    for link in reversed(links):
        below = link.join(found.withColumnRenamed("item", "parent"), "parent")
        # items that skipped this level are in found themselves; composites are not asked for again
        found = found.unionByName(below.select("item", "shard"))
    return found


def byte_shards(docs: DataFrame, shards: int = 24) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (gapless in its shard)."""
    text = F.coalesce("text", F.lit(""))
    rows = stage(plain(docs).select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.md5(text).alias("item")),
        "sized").df
    groups = stage(rows.groupBy("item").agg(F.sum("size").alias("size")), "groups").df
    placed = stage(rows.join(stage(assign(groups, shards), "group-shards").df, "item"),
                   "placed").df
    return (number(placed, ["shard"], ["doc_id", "item"], "slot")
            .select("doc_id", "size", "text_crc32", "shard", "slot"))
