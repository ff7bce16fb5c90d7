"""A training corpus from ``documents``: quality, deduplication, mix, packing.

Each stage takes what its predecessor kept; all but the last return the
columns of its input, whatever else they are called.

Null texts count as empty. The classifier scores every text, the empty one
too. Of equal texts (A-Z and a-z alike) the largest ``doc_id`` stays, a null id
only where there is no other; of texts that are nearly equal the smallest, null
last. Texts without words have no near copies and stand outside the budgets
of the mix, which keeps them once. Rows that repeat one another are equal texts,
so one of them is left. An empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itemwise.llm import exact_dedup, mixing, ngram_join, packing, quality
from itemwise.llm.common import fresh, stage

#: No stage but the second is expressible in SQL; tests hold them against brute force.
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores at its threshold or above."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score, = fresh(docs, "score")
    return (quality.score(docs, model, score).where(F.col(score) >= quality.THRESHOLD)
            .select(*docs.columns))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the largest doc_id."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of five-word shingles at Jaccard 0.8 or more."""
    return ngram_join.drop_near_copies(docs, words=5, num=80, den=100)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 4096 tokens: one row per piece, with its ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2,
                        text_bytes=packing.CLOSE_BYTES)


STAGES = [("quality", keep_good), ("exact_dedup", drop_copies),
          ("near_dedup", drop_near_copies), ("mix", mix_sources), ("pack", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name).df
    return STAGES[-1][1](spark, docs, sf_dir)
