"""Helpers that several operators share."""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from itemwise.session import ensure_checkpoint_dir

A_Z, LOWER_A_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The white space of a word: ASCII blank and 0x09 to 0x0D.
BLANKS = "\\x20\\x09-\\x0D"


@dataclass
class Table:
    """A frame written once into the cluster's shared folder."""

    df: DataFrame
    path: str

    def drop(self) -> None:
        """Delete the files; only for tables that nothing lazy reads."""
        spark = self.df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shared_path(spark, name: str) -> str:
    """A fresh path under the folder that ``spark.checkpoint.dir`` names."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/itemwise/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> Table:
    """Write ``df`` as Parquet in the shared folder and read it back: the
    lineage ends there, a lost executor costs a re-read, and both sides of a
    later join are plain scans, which Spark can split when a key is hot."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return Table(df.sparkSession.read.schema(df.schema).parquet(path), path)


def same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Null-safe equality of ``keys`` for a join of aliased frames l and r."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
    return cond


def id_key(doc_id: Column) -> Column:
    """An id as a join key that is never null, so that the join's
    partitioning serves later steps by the same key."""
    return F.coalesce(doc_id.cast("string"), F.lit("null"))


def fresh(docs: DataFrame, *names: str) -> list[str]:
    """``names``, underscored until no column of ``docs`` is called so."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = f"_{n}"
        out.append(n)
    return out


def number(table: DataFrame, keys: list[str], order: list[str], name: str,
           seed: int = 0, chunk_rows: int = 4096) -> DataFrame:
    """Add column ``name``: 0, 1, ... without gaps within each value of
    ``keys``, in a seeded order of ``order``.

    No key needs to fit one task: rows of a key are dealt into chunks by a
    seeded hash of ``order``, numbered inside their chunk, and shifted by the
    counts of the chunks before. ``table`` is read twice, so give a written
    one. Nulls in keys form a group of their own.
    """
    chunks = max(1, math.ceil(table.count() / chunk_rows))
    dealt = table.withColumn("_chunk", F.pmod(F.xxhash64(F.lit(seed), *order), F.lit(chunks)))
    counts = dealt.groupBy(*keys, "_chunk").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = counts.select(*keys, "_chunk",
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    rows = dealt.withColumn("_in", F.row_number().over(inside) - 1)
    joined = rows.alias("l").join(starts.alias("r"), same(rows, starts, [*keys, "_chunk"]))
    return joined.select(*[F.col(f"l.{c}") for c in table.columns],
                         (F.col("r._start") + F.col("l._in")).alias(name))


def ranked(table: DataFrame, group: list[str], order: list[str], name: str,
           range_rows: int = 1 << 15) -> Table:
    """``table`` written again with column ``name``: 0, 1, ... without gaps
    within each value of ``group``, by ``order`` ascending (nulls first).

    Rows are sorted into ranges of all groups together, numbered inside their
    range, and shifted by the counts of the group's ranges before. So no
    group needs to fit one task; let ``order`` end with a row id where rows
    repeat. ``table`` is read twice, so give a written one. Nulls in
    ``group`` form a group of their own.
    """
    ranges = max(1, math.ceil(table.count() / range_rows))
    keys = [F.col(c).asc_nulls_first() for c in [*group, *order]]
    dealt = stage(table.repartitionByRange(ranges, *keys)
                  .withColumn("_range", F.spark_partition_id()), "ranges")
    counts = dealt.df.groupBy(*group, "_range").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = counts.select(*group, "_range",
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*group, "_range").orderBy(
        *[F.col(c).asc_nulls_first() for c in order])
    rows = dealt.df.withColumn("_in", F.row_number().over(inside) - 1)
    joined = rows.alias("l").join(starts.alias("r"), same(rows, starts, [*group, "_range"]))
    out = stage(joined.select(*[F.col(f"l.{c}") for c in table.columns],
                              (F.col("r._start") + F.col("l._in")).alias(name)), "ranked")
    dealt.drop()
    return out


def plain(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` only, so that no other column can clash."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
