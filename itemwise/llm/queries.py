"""One registered query per operator, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from itemwise.llm import (
    bin_completion,
    exact_dedup,
    huffman,
    knn,
    merkle,
    mixing,
    ngram_join,
    packing,
    paragraphs,
    quality,
    repair,
    sharding,
    token_counts,
)
from itemwise.llm.common import shared_path

BYTE_BPE, WORD_BPE, END_ID, TOKEN_LIMIT = "byte_bpe_50k.json", "word_bpe_49k.json", 2, 1024


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = huffman.write_and_read(_table(spark, sf_dir, "documents"),
                                  public_tokenizers.path(BYTE_BPE), END_ID)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op2_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.byte_shards(_table(spark, sf_dir, "documents"), 24).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op4_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(_table(spark, sf_dir, "documents"),
                                  _table(spark, sf_dir, "labels"))


def op5_repeated_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.repeated_paragraphs(_table(spark, sf_dir, "documents"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_classes(_table(spark, sf_dir, "documents"), words=3, num=90,
                                   den=100).drop("h")


def op7_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE),
                          END_ID)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


def op8_voronoi_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn.voronoi_knn(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"), keep="max")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a cache of its own for each call, so that no count comes from an earlier one
    counts = token_counts.token_counts(_table(spark, sf_dir, "documents"),
                                       public_tokenizers.path(BYTE_BPE),
                                       shared_path(spark, "token-count-cache"))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op11_bin_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = bin_completion.pack(_table(spark, sf_dir, "documents"),
                                 public_tokenizers.path(BYTE_BPE), end_id=0)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id",
                         "offset")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return merkle.proofs(_table(spark, sf_dir, "documents"), tampered)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.damaged_and_repaired(_table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (
    op1_huffman_ids, op2_byte_shards, op3_mix_sources, op4_quality_scores,
    op5_repeated_paragraphs, op6_ngram_join, op7_pack_sequences, op8_voronoi_knn,
    op9_exact_dedup, op10_token_counts, op11_bin_completion, op12_merkle_manifest,
    op13_conversation_repair)} | {"pipeline": corpus_pipeline.run}

_LOWER = ("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          "'abcdefghijklmnopqrstuvwxyz')")

SQL = {
    "op9_exact_dedup": f"""
        with t as (select doc_id, sha256({_LOWER}) as text_sha256 from documents)
        select doc_id, max(doc_id) over g as keep_id, count(*) over g as group_size,
               doc_id = max(doc_id) over g as kept, text_sha256
        from t window g as (partition by text_sha256)""",
    "op8_voronoi_knn": """
        with v as (
            select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v
            from embeddings),
        s as (
            select q.vec_id as query_id, c.vec_id,
                   list_inner_product(q.v, c.v)::bigint as score
            from v q join v c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id),
        r as (select *, row_number() over (partition by query_id
                                           order by score desc, vec_id) as rank from s)
        select query_id, rank::integer as rank, vec_id, score from r where rank <= 5""",
    "op6_ngram_join": f"""
        with recursive w as (
            select doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') as w
            from documents),
        g as (
            select distinct doc_id, unnest(
                case when len(w) = 0 then []
                     when len(w) < 3 then [array_to_string(w, ' ')]
                     else list_transform(range(1, len(w) - 1),
                                         lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
                end) as g from w),
        n as (select doc_id, count(*) as n from g group by doc_id),
        o as (select a.doc_id as a, b.doc_id as b, count(*) as c
              from g a join g b on a.g = b.g and a.doc_id <> b.doc_id group by all),
        l as (select a, b from o join n x on x.doc_id = a join n y on y.doc_id = b
              where 100 * c >= 90 * (x.n + y.n - c)),
        r as (select doc_id as node, doc_id as found from w
              union select r.node, l.b from r join l on l.a = r.found)
        select w.doc_id, coalesce(any_value(n.n), 0)::bigint as n_shingles,
               min(r.found) as component_id
        from w left join n on n.doc_id = w.doc_id join r on r.node = w.doc_id
        group by w.doc_id""",
}
