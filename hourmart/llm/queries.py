"""Registered queries of the operators, their SQL and the corpus pipeline's entry.

Each query applies one operator with its production parameters to its whole
table and derives the reported columns from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourmart.llm import alignment as A
from hourmart.llm import decontaminate as D
from hourmart.llm import embeddings as E
from hourmart.llm import langid as L
from hourmart.llm import licenses as LI
from hourmart.llm import minhash as M
from hourmart.llm import mixing as MX
from hourmart.llm import packing as PK
from hourmart.llm import search as SE
from hourmart.llm import secrets as S
from hourmart.llm import shards as SH
from hourmart.llm import token_counts as TC
from hourmart.llm import warc as W
from hourmart.llm.common import scratch, ship
from hourmart.llm.sql import SQL  # noqa: F401


def tokenizer(name: str) -> str:
    """Path of a public tokenizer file; only its name is ours."""
    import public_tokenizers

    return public_tokenizers.path(name)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.near_duplicates(read(spark, sf_dir, "documents"), k=2, percent=80)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TC.token_counts(read(spark, sf_dir, "documents").select("doc_id", "text"),
                           tokenizer("byte_bpe_50k.json"), limit=512) \
        .select("doc_id", "n_bytes", "n_tokens", "over_limit")


def held_out(id_col: str = "doc_id") -> F.Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % F.lit(3) == F.lit(1), F.lit(False))


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    trees = L.fit(docs, F.col("doc_id").isNotNull() & ~held_out())
    return L.predict(docs.select("doc_id", "text"), trees) \
        .select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "bits_per_byte")


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return LI.license_scan(read(spark, sf_dir, "documents"))


def op5_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(1)
    return SH.histogram_shards(docs, "doc_id", size, shards=16).select(
        "doc_id", "size", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = D.decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return hits.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                       (F.col("n_hit") > 0).alias("contaminated"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    W.write_warc(read(spark, sf_dir, "pages"), path)
    return W.payload_summary(W.read_warc(spark, path))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = S.secret_spans(read(spark, sf_dir, "documents").select("doc_id", "text"))

    def n(kind: str) -> F.Column:
        index = S.KINDS.index(kind)
        return F.size(F.filter("secrets", lambda s: s["kind"] == F.lit(index))).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", n("assign"), n("access"), n("hex"),
                        F.sha2(S.spans_text(S.base_spans(F.col("secrets"))), 256).alias("base_sha256"),
                        S.spans_text(F.col("secrets")).alias("spans"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = PK.pack(read(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset", "loss_tokens")


def op10_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.near_vectors(read(spark, sf_dir, "embeddings"))


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return MX.mix(read(spark, sf_dir, "documents").select("doc_id", "text", "source")) \
        .select("doc_id", "size", "source_size", "target", "taken", "passes")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.align(read(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"))


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SE.ranked_search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), k=20)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_minhash, op2_token_counts, op3_langid, op4_licenses, op5_shards, op6_decontaminate,
                            op7_warc, op8_secrets, op9_packing, op10_embeddings, op11_mixing, op12_alignment,
                            op13_search)}
