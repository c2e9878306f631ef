"""Stages of a corpus pipeline: each takes (spark, docs, sf_dir), applies one operator to all of docs and returns a
DataFrame. All but packing return the columns of docs, whatever further columns there are.

Defined cases: the operators' own; a rejected row goes, all others stay; of equal rows one stays in ``near_duplicates``,
where rows that share an id but not a text are judged each by its own; empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm import decontamination, neardup, packing, secret_ledger, toxicity
from tessella.llm.tables import fresh, public_tokenizer, table
from tessella.session import scratch_path


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are rejected as toxic go."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    model = toxicity.fit(docs.select("doc_id", "text").join(labels, "doc_id"))
    names = []
    for name in ("severity", "p_toxic", "grade", "toxic"):
        names.append(fresh(name, docs.columns + names))
    return toxicity.with_severity(docs, model, tuple(names)).filter(~F.col(names[-1])).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    found = neardup.classes(docs)
    gone = found.filter("NOT kept").select(F.col("doc_id").alias("gone_id"), F.col("content").alias("gone_content"))
    content = fresh("content", docs.columns)
    named = docs.withColumn(content, neardup.content_of(docs["text"]))
    same = named["doc_id"].cast("long").eqNullSafe(gone["gone_id"]) & (named[content] == gone["gone_content"])
    left = named.join(gone, same, "left_anti")
    if found.filter("kept").groupBy("doc_id", "content").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).count():
        left = left.dropDuplicates(["doc_id", content])
    return left.select(*docs.columns)


def benchmark_overlaps(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    row = fresh("row", docs.columns)
    named = docs.withColumn(row, F.xxhash64("doc_id", "text"))
    found = decontamination.overlaps(named.select(row, "text"), table(spark, sf_dir, "benchmark"), [row])
    return named.join(found.select(row).distinct(), row, "left_anti").select(*docs.columns)


def redacted_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret found is blotted out; all documents stay."""
    blob, spans = fresh("blob", docs.columns), fresh("spans", docs.columns)
    ledger = scratch_path(spark, "secret-ledger")
    secret_ledger.update(docs.select(F.col("doc_id").alias("key"), secret_ledger.blob_id().alias("blob"), F.coalesce("text", F.lit("")).alias("text")), ledger)
    found = secret_ledger.findings(spark, ledger).select(F.col("blob").alias(blob), F.col("spans").alias(spans))
    joined = docs.withColumn(blob, secret_ledger.blob_id()).join(found, blob, "left")
    clean = F.when(F.col(spans).isNull(), F.col("text")).otherwise(secret_ledger.redacted(F.col("text"), F.col(spans)))
    out = joined.withColumn("text", clean)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col(spans).isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    return out.select(*docs.columns)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizer("byte_bpe_50k.json"))
