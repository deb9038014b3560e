"""From raw documents to training shards: every stage takes all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickerloom.llm import decontaminate, mixing, sharding, simhash, toxicity
from tickerloom.llm.text import documents, kept_table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.without_toxic(docs, model)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, decontaminate.fit(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def shard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mix_stage),
    ("sharding", shard_stage),
]
ORACLE_SQL = None  # the checksum and the models of the first stages are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = kept_table(stage(spark, docs, sf_dir), f"corpus-{name}")
    return docs
