"""Token counts behind a digest cache.

The cache is a Parquet table (tokenizer digest, content digest, byte length,
count). Documents are reduced to digests; those without a cached count are
reduced to one representative each, whose text alone is read again and
encoded; the new counts are appended to the cache; then every document looks
up its count. A tokenizer's digest is the SHA-256 of its vocabulary file and
of the version of the encoding rules, so another tokenizer never reads these
counts. Content is normalised only where no tokenizer can tell: null becomes
the empty text.

Texts are shuffled once at most, and digests (not texts) meet in joins on
content; both sides of those joins are written tables, so a text that holds a
third of all rows is split by Spark.

Contract: one row per input row; null text counts as empty; repeated ids are
counted row by row; an empty table returns none; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemwise.llm.common import plain, same, stage
from itemwise.llm.tokens import ENCODED_ROWS, encoder, in_slices

RULES = b"ids of tokenizers, no added special tokens, special strings as in the file"
_CACHE = "tokenizer string, sha binary, n_bytes long, n_tokens long"


def tokenizer_digest(vocabulary: str) -> str:
    with open(vocabulary, "rb") as f:
        return hashlib.sha256(f.read() + RULES).hexdigest()


def open_cache(spark, folder: str) -> DataFrame:
    """The cache, empty before its first write."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], _CACHE)
    return spark.read.schema(_CACHE).parquet(folder)


def _encode(texts: DataFrame, vocabulary: str) -> DataFrame:
    def run(batches):
        enc = encoder(vocabulary)
        for batch in batches:
            for part in in_slices(batch, ENCODED_ROWS):
                n = [len(x) // enc.width for x in enc.encode(part.column("text").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column("sha"), part.column("n_bytes"), pa.array(np.array(n, np.int64))],
                    names=["sha", "n_bytes", "n_tokens"])

    return texts.mapInArrow(run, "sha binary, n_bytes long, n_tokens long")


def token_counts(docs: DataFrame, vocabulary: str, cache: str) -> DataFrame:
    """doc_id, n_bytes and n_tokens of every document; ``cache`` is the folder
    of the cache and grows by the distinct texts it did not hold."""
    spark = docs.sparkSession
    version = tokenizer_digest(vocabulary)
    text = plain(docs).withColumn("text", F.coalesce("text", F.lit("")))
    named = text.select("doc_id", "text", F.unhex(F.sha2("text", 256)).alias("sha"),
                        F.octet_length("text").cast("long").alias("n_bytes"))
    digests = stage(named.drop("text"), "content-digests").df
    stored = open_cache(spark, cache).where(F.col("tokenizer") == version)
    # any row of a group may speak for it: equal digests, equal texts
    misses = (digests.groupBy("sha", "n_bytes").agg(F.min("doc_id").alias("doc_id"))
              .join(stored, ["sha", "n_bytes"], "left_anti"))
    wanted = stage(misses, "cache-misses").df.alias("r")
    asked = (named.alias("l").join(wanted, same(named, misses, ["doc_id", "sha"]), "left_semi"))
    new = _encode(asked, vocabulary)
    (new.groupBy("sha", "n_bytes").agg(F.max("n_tokens").alias("n_tokens"))
     .select(F.lit(version).alias("tokenizer"), "sha", "n_bytes", "n_tokens")
     .write.mode("append").parquet(cache))
    # jobs that append at once, or one that runs again, may store a count twice
    counts = stage(open_cache(spark, cache).where(F.col("tokenizer") == version)
                   .groupBy("sha", "n_bytes").agg(F.max("n_tokens").alias("n_tokens")),
                   "cached-counts").df
    return digests.join(counts, ["sha", "n_bytes"]).select("doc_id", "n_bytes", "n_tokens")
