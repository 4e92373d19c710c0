"""Corpus pipeline: from ``documents`` to token ids, in five stages.

Toxic documents go; one document of each near-duplicate group stays; personal data is masked;
sources are mixed to their target weights; texts become token ids. Each stage takes
(spark, docs, sf_dir) and returns a DataFrame; all but the last have the columns of
``documents``. ``run`` saves every stage as a table in the shared folder that
``spark.checkpoint.dir`` names, so a lost executor never costs more than one stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airlake.llm import bpe, mixing, neardup, pii, toxicity
from airlake.llm.queries import learnable
from airlake.llm.tables import read
from airlake.session import shared_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold. Labels are those of the ``documents`` table;
    the language model comes from all of ``docs``."""
    inner = docs.select(F.struct("*").alias("row"), "doc_id", "text")
    scored = toxicity.toxicity(inner, learnable(spark, sf_dir, "toxic"), read(spark, sf_dir, "documents"))
    return scored.where(F.col("score") < toxicity.THRESHOLD).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return neardup.deduplicate(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; ``n_chars`` follows the new text."""
    return pii.redact(docs).withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix draws it."""
    return mixing.mix(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and the digest of what they decode to."""
    return bpe.encode(docs.select("doc_id", "lang", "source", "text"), offsets=False, decoded=True).drop("text")


STAGES = [
    ("toxicity", drop_toxic),
    ("near-duplicates", drop_near_duplicates),
    ("personal data", mask_personal_data),
    ("mixing", mix_sources),
    ("tokens", tokenize),
]

#: The language model, the learned scores and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    folder = shared_dir(spark, f"pipeline-{uuid.uuid4().hex}")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
