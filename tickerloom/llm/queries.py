"""Queries of the operators, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerloom.llm import (
    collocations,
    conversations,
    decontaminate,
    html_extract,
    lattice,
    license_scan,
    mixing,
    quality,
    secrets,
    sharding,
    simhash,
    substring_dedup,
    toxicity,
)
from tickerloom.llm.text import documents


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.dedup(documents(spark, sf_dir))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(documents(spark, sf_dir))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op5_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(documents(spark, sf_dir))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.severity(docs, model)


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = secrets.scan(docs, secrets.train(docs))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans"
    )


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(documents(spark, sf_dir))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).drop("n_copies")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    index = decontaminate.fit(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return decontaminate.contaminated(docs, index)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(documents(spark, sf_dir))


def op12_lattice_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return lattice.score(docs, lattice.fit(docs))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return conversations.repair(conversations.damaged(rows), rows)


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_sharding": op2_sharding,
    "op3_simhash": op3_simhash,
    "op4_html_extraction": op4_html_extraction,
    "op5_license_scans": op5_license_scans,
    "op6_toxicity": op6_toxicity,
    "op7_secret_scans": op7_secret_scans,
    "op8_quality_rules": op8_quality_rules,
    "op9_mixing": op9_mixing,
    "op10_decontamination": op10_decontamination,
    "op11_collocations": op11_collocations,
    "op12_lattice_scores": op12_lattice_scores,
    "op13_conversation_repair": op13_conversation_repair,
}
