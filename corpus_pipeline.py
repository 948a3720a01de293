"""The corpus pipeline: stages over ``documents``, each written as Parquet and reread by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from activation_mart.llm import decontamination, minhash, mixing, resampling, sharding
from activation_mart.llm.rows import held, released
from activation_mart.session import current_scratch

ORACLE_SQL = None  # hashed models and signatures have no SQL; tests compare with brute force


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier draws; those it rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return released(resampling.resample(held(docs, "doc_id", "text"), labels).filter("__kept"), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the least doc_id."""
    return minhash.without_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontamination.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of each document of the mix; its texts are the stage before, which ``run`` leaves beside it."""
    return sharding.shard_documents(docs)


STAGES = [
    ("quality classifier", classify_quality),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("source mix", mix_sources),
    ("sharding", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder: shards and slots of the documents left.

    The stages state what NULLs, empty and long texts, repeated rows and extra
    columns give; documents of an empty table give an empty result. Each
    stage's documents lie in the shared folder, and go with the run around the
    caller (``run_scope``).
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = current_scratch(spark).path("corpus-pipeline")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name.replace(' ', '-')}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
