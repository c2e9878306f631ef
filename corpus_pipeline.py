"""A training-corpus pipeline: toxic documents go, one of each class of near duplicates stays, documents with
passages of the benchmark go, secrets are blotted out, and what is left is packed into sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessella.llm import stages
from tessella.session import scratch_path

STAGES = [
    ("toxicity", stages.toxic_documents),
    ("near_dedup", stages.near_duplicates),
    ("decontamination", stages.benchmark_overlaps),
    ("secret_scan", stages.redacted_secrets),
    ("packing", stages.packed_sequences),
]

#: The models, signatures and tokens of the stages have no form in SQL; tests check run() against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
