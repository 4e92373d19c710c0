"""Registered queries of the operators, with production parameters, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airlake.llm import bpe, chat, clusters, fingerprint, hamming, manifest, mixing, neardup, passages, pii, quality, tokencounts, toxicity
from airlake.llm.tables import documents, held_out, read

#: Length of the vectors in ``embeddings``.
EMBEDDING_DIMENSION = 64
#: Tokens above which a document counts as over the limit.
TOKEN_LIMIT = 4096


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.with_next(documents(spark, sf_dir, "doc_id", "text"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(pii.detect(documents(spark, sf_dir, "doc_id", "text")), ["doc_id"])


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = mixing.draw(documents(spark, sf_dir, "doc_id", "text", "source"))
    return drawn.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op6_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.digests(documents(spark, sf_dir, "doc_id", "text"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(documents(spark, sf_dir, "doc_id", "text"))


def learnable(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    """Labels that may be learned from, one row per document id."""
    return read(spark, sf_dir, "labels").where(~held_out()).groupBy("doc_id").agg(F.max(label).alias(label))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.toxicity(documents(spark, sf_dir, "doc_id", "text"), learnable(spark, sf_dir, "toxic"))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    scored = quality.score(docs, quality.fit(docs, learnable(spark, sf_dir, "quality")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = "\\### Assistant: </turn> ok"                  # holds the template's own control strings
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(odd).alias("text"))
    return chat.digests(chat.windows(turns.unionByName(extra)))


def op9_hamming(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    found = hamming.top_k(vectors, vectors.where("vec_id % 100 = 0"), EMBEDDING_DIMENSION)
    return found.select(F.col("query").alias("query_id"), F.col("id").alias("vec_id"), "distance", "rank")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir, "doc_id", "text"), ["doc_id"])


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.report(documents(spark, sf_dir, *manifest.FIELDS))


def op12_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.report(read(spark, sf_dir, "embeddings"), EMBEDDING_DIMENSION)


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = tokencounts.count(documents(spark, sf_dir, "doc_id", "text"), TOKEN_LIMIT)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit", "limit_chars")


QUERIES = {"op1_fingerprints": op1_fingerprints, "op2_pii": op2_pii, "op3_mixing": op3_mixing, "op4_near_duplicates": op4_near_duplicates, "op5_toxicity": op5_toxicity, "op6_passages": op6_passages, "op7_quality": op7_quality, "op8_chat": op8_chat, "op9_hamming": op9_hamming, "op10_bpe": op10_bpe, "op11_manifest": op11_manifest, "op12_clusters": op12_clusters, "op13_token_counts": op13_token_counts}
ORACLE: dict[str, str] = {"op3_mixing": mixing.ORACLE, "op6_passages": passages.ORACLE, "op8_chat": chat.ORACLE, "op11_manifest": manifest.ORACLE, "op12_clusters": clusters.oracle(EMBEDDING_DIMENSION)}
