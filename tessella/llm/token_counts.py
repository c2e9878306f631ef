"""Token counts by a digest cache.

The cache is a Parquet table of (content, tokenizer, n_tokens): the digest of a text's normalised content, the
digest of the tokenizer's file and library version, and the count. A run joins the digests of its documents to the
cache, encodes each distinct text that it misses once, appends those counts, and joins all counts back to the
documents. Another run over the same or overlapping texts encodes only what is new; another tokenizer version
misses everything and leaves the old counts alone.

Defined cases: a null text counts as empty, 0 tokens; an empty table gives no rows; repeated rows stay repeated
rows; a null id stays null; texts are never cut, and special strings in them are what the library makes of them.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm.tables import map_batches, texts_of, whole_text
from tessella.llm.tokenization import encoder, file_digest

CACHE = "content string, tokenizer string, n_tokens long"


def content_digest(text: Column | str = "text") -> Column:
    """Digest of the normalised content. The tokenizer sees every character, so the only normalisation that
    keeps counts right is that null is empty; what the tokenizer itself normalises is part of its version."""
    return F.sha2(whole_text(text).cast("binary"), 256)


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """The cache at ``path``, or an empty one where none has been written yet."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], CACHE)
    # a lost race or a retried run may have added a count twice
    return spark.read.schema(CACHE).parquet(path).dropDuplicates(["content", "tokenizer"])


def encode_counts(texts: DataFrame, tokenizer: str) -> DataFrame:
    """(content, n_tokens) of rows (content, text)."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        # rows that stand there twice come one after the other
        encode, texts = encoder(tokenizer).encode, dict(zip(batch.column(0).to_pylist(), texts_of(batch).to_pylist(), strict=True))
        counts = [len(encode(t)) // 4 for t in texts.values()]
        return pa.RecordBatch.from_arrays([pa.array(list(texts), pa.string()), pa.array(counts, pa.int64())], ["content", "n_tokens"])

    return map_batches(texts.select("content", "text"), work, "content string, n_tokens long")


def count_tokens(docs: DataFrame, tokenizer: str, cache: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes and n_tokens of each document; ``cache`` is the path of the cache table."""
    spark, version = docs.sparkSession, file_digest(tokenizer)
    text = whole_text(docs[text_col])
    keyed = docs.select(docs[id_col].alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), content_digest(docs[text_col]).alias("content"))

    # one row of each digest; only its key moves, and the text of that row is fetched by key afterwards
    one = keyed.groupBy("content").agg(F.min("doc_id").alias("doc_id"))
    known = read_cache(spark, cache).filter(F.col("tokenizer") == version)
    missed = one.join(known, "content", "left_anti")
    texts = docs.select(docs[id_col].alias("of"), content_digest(docs[text_col]).alias("digest"), text.alias("text"))
    found = missed.join(texts, texts["of"].eqNullSafe(missed["doc_id"]) & (F.col("digest") == F.col("content")))
    counts = encode_counts(found, tokenizer).select("content", F.lit(version).alias("tokenizer"), "n_tokens")
    counts.write.mode("append").parquet(cache)

    known = read_cache(spark, cache).filter(F.col("tokenizer") == version).select("content", "n_tokens")
    return keyed.join(known, "content").select("doc_id", "n_bytes", "n_tokens")
