"""Registered queries of the corpus operators: each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm import centroids, decision_list, decontamination, fingerprints, language, neardup, packing, quality, secret_ledger, statistics, substrings, token_counts, toxicity, tries
from tessella.llm.oracle import ORACLE
from tessella.llm.tables import fold, public_tokenizer, store, table
from tessella.session import scratch_path

__all__ = ["ORACLE", "REGISTRY"]

TOKENIZER = "byte_bpe_50k.json"
TOKEN_LIMIT = 512


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # ``spark.tessella.tokenCache`` names a cache that outlives the run
    cache = spark.conf.get("spark.tessella.tokenCache", None) or scratch_path(spark, "token-cache")
    counts = token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizer(TOKENIZER), cache)
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizer(TOKENIZER))


def op2_quality_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold("doc_id", 5) == 0)
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    # labels grow with the documents, so they are shuffled at every size
    model = quality.fit(docs.filter("NOT held_out").select("doc_id", "text").join(labels.hint("merge"), "doc_id"))
    scores = quality.score(docs, model)
    return scores.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op3_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    # ``spark.tessella.secretLedger`` names a ledger that outlives the run
    ledger = spark.conf.get("spark.tessella.secretLedger", None) or scratch_path(spark, "secret-ledger")
    found = secret_ledger.scan_versions(table(spark, sf_dir, "documents"), ledger)
    number = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    listed = secret_ledger.as_text(F.col("spans"))
    return found.select("doc_id", *[number(r.kind) for r in secret_ledger.RULES], F.sha2(listed.cast("binary"), 256).alias("base_sha256"), listed.alias("spans"))


def op4_toxicity_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    return toxicity.score(docs, toxicity.fit(docs.join(labels, "doc_id")))


def op5_language_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", fold("doc_id", 3) == 1)
    model = language.fit(docs.filter("NOT held_out"))
    found = language.predict(docs, model)
    return found.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


def op7_block_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op8_weighted_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "kept")


def op9_bottom_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.with_neighbours(table(spark, sf_dir, "documents"))


def op10_spaced_seed_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontamination.overlaps(docs, table(spark, sf_dir, "benchmark"))


def op11_decision_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = store(statistics.statistics(table(spark, sf_dir, "documents"), ["doc_id"]), "text-statistics")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    counted = counted.withColumn("base_failed", failed)
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    # labels grow with the documents, so they are shuffled at every size
    passed = counted.filter("NOT base_failed").join(labels.hint("merge"), "doc_id")
    rules = decision_list.fit(passed.select("label", *decision_list.features()))
    shown = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    judged = counted.select(*[F.col(c).alias(f"own_{c}") for c in shown], *decision_list.features()).withColumn("rule", rules.number())
    out = judged.select(*[F.col(f"own_{c}").alias(c) for c in shown], F.when(F.col("own_base_failed"), F.lit(0)).otherwise(F.col("rule")).alias("rule"))
    return out.withColumn("kept", F.col("rule").isNull())


def op12_hadamard_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clusters(table(spark, sf_dir, "embeddings"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tries.trie(table(spark, sf_dir, "conversations"))


REGISTRY = {
    "op1_token_counts": op1_token_counts,
    "op2_quality_nbsvm": op2_quality_nbsvm,
    "op3_secret_ledger": op3_secret_ledger,
    "op4_toxicity_ordinal": op4_toxicity_ordinal,
    "op5_language_hierarchy": op5_language_hierarchy,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_block_anchors": op7_block_anchors,
    "op8_weighted_minhash": op8_weighted_minhash,
    "op9_bottom_k": op9_bottom_k,
    "op10_spaced_seed_decontamination": op10_spaced_seed_decontamination,
    "op11_decision_lists": op11_decision_lists,
    "op12_hadamard_centroids": op12_hadamard_centroids,
    "op13_prefix_trie": op13_prefix_trie,
}
