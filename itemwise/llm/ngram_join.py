"""N-gram Jaccard join: a blocked sparse product of documents and n-grams.

The incidence matrix (documents x distinct word n-grams) is multiplied with
its own transpose in blocks of columns (the shuffle's partitions) and rows.
Sizes bound what has to be formed: a row of n n-grams that reaches Jaccard t
with another shares at least ceil(t * n) of them, so whatever one order all
n-grams are put in, two linked rows meet among their first
n - ceil(t * n) + 1. Only these entries of a row take part in the product;
pairs that meet in none are below the bound and are never formed. The order
puts rare n-grams first, so that a passage, line or phrase that very many
documents share is in no short prefix: a table of ``BUCKETS`` counts over all
n-grams of all documents, of fixed size at any scale, ranks them. The table
steers the work only; any order gives the same links. Pairs that meet are
held against a second bound first, parities and counts of both sets in a few
hundred cells, which rules most of them out before a text moves. The overlap of what is
left is counted exactly (``shingles.linked``), block pair by block pair, and
components of the links are the classes.

Contract: A-Z are lower-cased, words are runs of non-blanks (ASCII); the set
of a document is its distinct n-word shingles, the whole sequence when it is
shorter; without words or text it is empty and links with nothing. Equal sets
link and are compared as one. Every input row returns once, repeated rows
too; a null doc_id is never the smallest; an empty table returns none; other
columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemwise.llm.common import Table, fresh, id_key, plain, stage
from itemwise.llm.shingles import (
    KEYS,
    SKETCH,
    cells,
    deal_keys,
    in_windows,
    linked,
    name,
    packed,
    shared_keys,
    shingle_set,
    sketch,
)
from itemwise.llm.tokens import in_slices

#: Counts that rank n-grams; a power of two.
BUCKET_BITS = 18


def _bucket(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def keys(shingles: np.ndarray, counts: np.ndarray, num: int, den: int) -> np.ndarray:
    """The entries of one row that take part: its rarest n - ceil(t * n) + 1."""
    n = len(shingles)
    order = np.lexsort((shingles, counts[_bucket(shingles)]))
    return shingles[order[: n + num * n // -den + 1]]


def _named(docs: DataFrame) -> DataFrame:
    return plain(docs).withColumn("h", F.xxhash64("text"))


def _sets(part, words: int):
    for text in part.column("text").to_pylist():
        yield shingle_set((text or "").encode("utf-8", "surrogatepass"), words)


def _described(named: DataFrame, words: int) -> tuple[Table, np.ndarray]:
    """doc_id, h, n_shingles, node (name of the set), sketch and cells of every
    row, written; and how often all documents hold the n-grams of each bucket, at
    most 2 ** BUCKET_BITS numbers whatever the corpus. One pass gives both: a
    task's counts follow its rows, told apart by ``bucket``."""

    def row(doc_ids, hashes, sets):
        drawn = np.stack([sketch(s) for s in sets])
        return [doc_ids, hashes, pa.array([len(s) for s in sets], pa.int64()),
                pa.array([name(s) for s in sets], pa.int64()),
                *[pa.array(np.ascontiguousarray(c)) for c in drawn.T],
                pa.nulls(len(sets), pa.int64()), pa.nulls(len(sets), pa.int64()),
                pa.array([cells(s) for s in sets], pa.binary())]

    columns = ["doc_id", "h", "n_shingles", "node", *SKETCH, "bucket", "held", "cells"]

    def run(batches):
        total = np.zeros(1 << BUCKET_BITS, dtype=np.int64)
        for batch in batches:
            for part in in_slices(batch):
                sets = list(_sets(part, words))
                total += np.bincount(_bucket(np.concatenate(sets)), minlength=len(total))
                yield pa.RecordBatch.from_arrays(
                    row(part.column("doc_id"), part.column("h"), sets), names=columns)
        at = np.flatnonzero(total)
        for i in range(0, len(at), 1 << 16):
            cut = at[i: i + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [*[pa.nulls(len(cut), pa.int64())] * (len(columns) - 3), pa.array(cut),
                 pa.array(total[cut]), pa.nulls(len(cut), pa.binary())], names=columns)

    described = stage(named.mapInArrow(
        run, ", ".join(f"{c} long" for c in columns[:-1]) + ", cells binary"), "set-names")
    found = (described.df.where("bucket is not null").groupBy("bucket")
             .agg(F.sum("held").alias("n")).toPandas())
    counts = np.zeros(1 << BUCKET_BITS, dtype=np.int64)
    counts[found["bucket"].to_numpy(dtype=np.int64)] = found["n"].to_numpy(dtype=np.int64)
    return Table(described.df.where("bucket is null").drop("bucket", "held"),
                 described.path), counts


def _rooted(docs: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """doc_id, h (hash of the text), n_shingles and the root of its class, of
    every row; written."""
    named = _named(docs)
    rows, counts = _described(named, words)

    def blocks(batches):
        def rows():
            for batch in batches:
                for part in in_slices(batch):
                    for s in _sets(part, words):
                        if len(s):
                            yield keys(s, counts, num, den), name(s)
        yield from deal_keys(rows())

    def contents(batches):
        for batch in batches:
            for part in in_slices(batch, 256):
                yield pa.RecordBatch.from_arrays(
                    [part.column("node"), part.column("n"), packed(
                        [t.encode("utf-8", "surrogatepass")
                         for t in part.column("text").to_pylist()])],
                    names=["node", "n", "body"])

    shared = shared_keys(named.select("text").mapInArrow(blocks, KEYS))
    sizes = stage(rows.df.groupBy("node").agg(
        F.min(F.struct("doc_id", "h")).alias("of"), F.max("n_shingles").alias("n"),
        *[F.max(c).alias(c) for c in [*SKETCH, "cells"]]), "sizes")
    members = in_windows(shared.df, sizes.df.select("node", "n"), num, den)
    # the text of one document of each set that shares a window with another
    speaker = stage(sizes.df.join(members.df.select("node").distinct(), "node", "left_semi")
                    .select("node", "n", id_key(F.col("of.doc_id")).alias("id"), "of.h"),
                    "speakers")
    # rows that repeat a document are one: the join's partitioning serves this too
    texts = (named.withColumn("id", id_key(F.col("doc_id")))
             .join(speaker.df.hint("merge"), ["id", "h"]).dropDuplicates(["id", "h"])
             .select("node", "n", "text"))
    sets = stage(texts.mapInArrow(contents, "node long, n long, body binary"), "candidate-texts")
    roots = linked(members.df, sets.df, words, num, den, sizes.df.drop("of"))
    for done in (shared, sizes, members, speaker, sets):
        done.drop()
    rooted = stage(rows.df.join(roots, "node", "left").select(
        "doc_id", "h", "n_shingles", F.coalesce("root", "node").alias("root")), "rooted").df
    rows.drop()
    return rooted


def near_classes(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """doc_id, h (hash of the text), n_shingles, component_id of every row."""
    rooted = _rooted(docs, words, num, den)
    least = stage(rooted.where("n_shingles > 0").groupBy("root").agg(
        F.min("doc_id").alias("least")), "smallest").df
    return rooted.join(least, "root", "left").select(
        "doc_id", "h", "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("doc_id"))
        .alias("component_id"))


def drop_near_copies(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` with one document of every class only, all columns kept: the
    smallest doc_id, null last, then the smallest hash of the text. Rows that
    share both are one document, so they stay or go together; documents
    without words are in no class and stay."""
    rooted = _rooted(docs, words, num, den)
    first = stage(rooted.where("n_shingles > 0").groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")).alias("first")),
        "first-of-class").df
    id_name, hash_name = fresh(docs, "_id", "_h")
    kept = (rooted.where("n_shingles = 0").select("doc_id", "h")
            .unionByName(first.select("first.doc_id", "first.h")).distinct()
            .select(id_key(F.col("doc_id")).alias(id_name), F.col("h").alias(hash_name)))
    key = F.xxhash64(F.col("text").cast("string"))
    return docs.join(kept, (id_key(docs["doc_id"].cast("long")) == kept[id_name])
                     & (key == kept[hash_name]), "left_semi")
