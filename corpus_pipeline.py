"""The corpus pipeline: documents in, token files out, in five stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from linktide.llm.decontaminate import decontaminate
from linktide.llm.mixing import mix_documents
from linktide.llm.near_dedup import drop_near_duplicates
from linktide.llm.quality import keep_good
from linktide.llm.token_output import token_output
from linktide.scratch import Scratch


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return keep_good(docs, labels)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays (five words, similarity 0.8)."""
    return drop_near_duplicates(docs, Scratch(spark))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; texts that are mostly benchmark go."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it."""
    return mix_documents(docs, Scratch(spark))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in ascending doc_id order, and what was read back from them."""
    return token_output(docs, Scratch(spark))


STAGES = [
    ("quality_classifier", quality_stage),
    ("minhash_near_dedup", near_dedup_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("mix_sources", mixing_stage),
    ("token_files", token_stage),
]

# The classifier and the tokenizer have no SQL; tests/llm/test_pipeline.py checks every
# stage against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage on what the one before kept, written as Parquet and read again."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs, _ = scratch.save(stage(spark, docs, sf_dir), name)
    return docs
