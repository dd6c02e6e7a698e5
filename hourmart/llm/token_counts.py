"""Token counts with a digest cache (operator 2).

The cache is a Parquet folder of (content digest, tokenizer digest, tokens).
Texts are joined to it by digest; only distinct texts it lacks are encoded,
and their counts are appended, so a later run over a grown corpus encodes
only what is new.

Normalisation may not change a count, so it is the one the count itself is
blind to: null becomes the empty text. The tokenizer digest is the SHA-256
of the tokenizer's file, so counts of another version are never reused.

* null or empty text: no bytes, no tokens; repeated rows each get a row.
* columns other than the id and the text are carried through untouched unless
  they clash with an output column, which then wins.
* a copy group of any size is one row per task before the shuffle, and a
  narrow join row after it (split by the skew join).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourmart.llm.common import scratch
from hourmart.llm.segments import SegmentEncoder

CACHE_SCHEMA = "content_digest binary, tokenizer_digest string, n_tokens long"


def tokenizer_digest(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def content_digest(text: F.Column) -> F.Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def read_cache(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """Counts known for this tokenizer; two runs that appended the same text leave one row."""
    return (spark.read.schema(CACHE_SCHEMA).parquet(cache)
            .where(F.col("tokenizer_digest") == version)
            .groupBy("content_digest").agg(F.max("n_tokens").alias("n_tokens")))


def start_cache(spark: SparkSession, cache: str) -> None:
    """Create an empty cache folder if there is none."""
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("ignore").parquet(cache)


def encode_misses(docs: DataFrame, text: str, tokenizer_path: str, cache: str) -> None:
    """Append the counts of the distinct texts of ``docs`` that the cache lacks."""
    spark = docs.sparkSession
    version = tokenizer_digest(tokenizer_path)
    # partial aggregation leaves one copy per task of a repeated text before the exchange,
    # and the anti join reuses the exchange's partitioning
    distinct = (docs.select(content_digest(F.col(text)).alias("content_digest"),
                            F.coalesce(F.col(text), F.lit("")).alias("text"))
                .groupBy("content_digest").agg(F.first("text").alias("text")))
    misses = distinct.join(read_cache(spark, cache, version), "content_digest", "left_anti")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = SegmentEncoder(tokenizer_path)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column("content_digest"), pa.array([version] * b.num_rows, pa.string()),
                 pa.array(encoder.counts(b.column("text")), pa.int64())],
                ["content_digest", "tokenizer_digest", "n_tokens"])

    misses.mapInArrow(count, CACHE_SCHEMA).write.mode("append").parquet(cache)


def token_counts(docs: DataFrame, tokenizer_path: str, text: str = "text", limit: int = 512,
                 cache: str | None = None) -> DataFrame:
    """``docs`` with n_bytes, n_tokens and over_limit (n_tokens > ``limit``).

    ``cache``: folder of the digest cache; a new one in the shared folder when not given.
    """
    spark = docs.sparkSession
    cache = cache or scratch(spark, "token-cache")
    start_cache(spark, cache)
    encode_misses(docs, text, tokenizer_path, cache)
    known = read_cache(spark, cache, tokenizer_digest(tokenizer_path))
    docs = docs.drop("n_bytes", "n_tokens", "over_limit", "content_digest")
    return (docs.withColumn("content_digest", content_digest(F.col(text)))
            .withColumn("n_bytes", F.coalesce(F.octet_length(text), F.lit(0)).cast("long"))
            .drop(*([text] if text not in docs.columns else []))
            .join(known, "content_digest", "left")
            .withColumn("over_limit", F.col("n_tokens") > F.lit(limit)))
