"""Exact deduplication by a tree-merge of sorted digest runs.

Every partition of the input is a run: its rows are reduced to one entry per
digest, in digest order. In each round ``fan_in`` neighbouring runs meet (run
r goes to run r // fan_in), are merged in digest order, and equal entries
become one that keeps the preferred identifier and the number of rows. After
ceil(log(runs)) rounds a single run is left, spread over partitions by
digest. An entry is found by a 64-bit digest and verified by the SHA-256 and
the byte length of the normalised text at every level, so two texts whose
64-bit digests collide stay apart.

Only DataFrame functions are used. A hot text is one entry per run after the
first reduction; the final join back is between two written tables, so Spark
splits a hot digest.

Contract: texts are equal when identical after lower-casing A-Z only; null
counts as empty. ``keep`` is "max" or "min" of doc_id; a null doc_id loses
against any other; of rows with the same doc_id and equal texts exactly one
is kept. Every input row returns once; an empty table returns none; columns
other than doc_id and text are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from itemwise.llm.common import A_Z, LOWER_A_Z, fresh, id_key, plain, stage

_KEY = ["d64", "sha", "n_bytes"]


def normalised(text):
    return F.translate(F.coalesce(text, F.lit("")), A_Z, LOWER_A_Z)


def _entries(docs: DataFrame, keep: str) -> DataFrame:
    """Digest rows with the run (input partition) they belong to."""
    text = plain(docs).select("doc_id", normalised(F.col("text")).alias("norm"))
    order = F.col("doc_id") if keep == "max" else -F.col("doc_id")
    return (text.withColumn("rid", F.monotonically_increasing_id())
            .select("doc_id", "rid", F.shiftright("rid", 33).alias("run"),
                    F.xxhash64("norm").alias("d64"),
                    F.unhex(F.sha2("norm", 256)).alias("sha"),
                    F.octet_length("norm").cast("long").alias("n_bytes"),
                    # max() prefers the wanted id, then the earliest row; null loses
                    F.struct(order.alias("o"), (-F.col("rid")).alias("r")).alias("best"))
            .sortWithinPartitions(*_KEY))


def merge_runs(entries: DataFrame, runs: int, fan_in: int = 16) -> DataFrame:
    """One entry per verified digest: best row and number of rows."""
    level = entries.groupBy("run", *_KEY).agg(F.max("best").alias("best"),
                                              F.count("*").alias("size"))
    for _ in range(max(1, math.ceil(math.log(max(runs, 1), fan_in)))):
        level = (level.withColumn("run", F.floor(F.col("run") / fan_in))
                 .groupBy("run", *_KEY).agg(F.max("best").alias("best"),
                                            F.sum("size").alias("size")))
    return level.drop("run")


def exact_dedup(docs: DataFrame, keep: str = "max", fan_in: int = 16) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    entries = stage(_entries(docs, keep), "digest-runs").df
    runs = (entries.agg(F.max("run")).first()[0] or 0) + 1
    merged = stage(merge_runs(entries, runs, fan_in), "digest-tree").df
    keep_id = F.col("best.o") if keep == "max" else -F.col("best.o")
    kept = merged.select("sha", "n_bytes", keep_id.alias("keep_id"),
                         (-F.col("best.r")).alias("keep_rid"), "size")
    return (entries.join(kept, ["sha", "n_bytes"])
            .select("doc_id", "keep_id", F.col("size").alias("group_size"),
                    (F.col("rid") == F.col("keep_rid")).alias("kept"),
                    F.lower(F.hex("sha")).alias("text_sha256")))


def drop_copies(docs: DataFrame, keep: str = "max") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns kept."""
    one, digest, n = fresh(docs, "_id", "_digest", "_n")
    kept = (exact_dedup(docs, keep).where("kept")
            .select(id_key(F.col("doc_id")).alias(one), F.col("text_sha256").alias(digest)))
    named = (docs.withColumn(one, id_key(F.col("doc_id").cast("long")))
             .withColumn(digest, F.sha2(normalised(F.col("text").cast("string")), 256)))
    found = named.join(kept, [one, digest], "left_semi")
    # identical rows share id and digest: the join's partitioning serves this too
    first = Window.partitionBy(one, digest).orderBy(F.lit(1))
    return found.withColumn(n, F.row_number().over(first)).where(F.col(n) == 1).select(
        *docs.columns)
