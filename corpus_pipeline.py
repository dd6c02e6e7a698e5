"""The corpus pipeline: language ID, near-duplicate removal, benchmark decontamination, secret redaction, packing.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
stage's docs. All but the last return the columns of ``documents``.

Near duplicates here are texts whose five-word shingle sets have a similarity
of 0.8 or more. Rows with the same doc_id are one document. Decisions:

* language: rows without text, without a letter, or whose best language model
  needs more bits per byte than storing the byte (8) go.
* near duplicates: the document with the smallest doc_id of each class stays.
* decontamination: documents that hold a benchmark window go.
* secrets: every span is replaced by ``[SECRET]``; ``n_chars`` follows the text.
* packing: sequences of 2048 tokens; a row per piece.

A null doc_id is never a copy of another document. Repeated rows of a doc_id
stay or go together. An empty table stays empty. Other columns pass through
unchanged, whatever their names; packing drops them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourmart.llm import decontaminate, langid, minhash, packing, secrets
from hourmart.llm.common import scratch, ship, sized_broadcast, store
from hourmart.llm.queries import held_out, tokenizer

RAW_BITS = 8.0


def _without(docs: DataFrame, dropped: DataFrame, keys: list[str]) -> DataFrame:
    """``docs`` less the rows whose ``keys`` are in ``dropped`` (narrow, written to the shared folder first)."""
    return docs.join(sized_broadcast(store(dropped.distinct(), "dropped")), keys, "left_anti")


def _row(docs: DataFrame) -> F.Column:
    """The whole row as one column: no column of ``docs`` can clash with what an operator adds."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


#: Rows that cross to Python at once: whole texts are large, and both sides hold a batch.
BATCH_ROWS = 500


def prepared(spark: SparkSession) -> None:
    """Ship the package, and keep a larger Arrow batch setting of the session down to ``BATCH_ROWS``."""
    ship(spark)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name, "10000")) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark)
    trees = langid.fit(docs, F.col("doc_id").isNotNull() & ~held_out())
    found = langid.predict(docs.select(_row(docs), "text"), trees)
    return found.where((F.col("lang_pred") != "und") & (F.col("bits_per_byte") < RAW_BITS)).select("row.*")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark)
    classes = minhash.near_duplicates(docs, k=5, percent=80)
    return _without(docs, classes.where(~F.col("kept")).select("doc_id"), ["doc_id"])


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    hits = decontaminate.window_hits(decontaminate.document_words(docs, "doc_id", "text"), items).select("doc_id", "key")
    keyed = docs.select(_row(docs), "doc_id", decontaminate.document_key(F.col("text")).alias("key"))
    named = _without(keyed, hits.where(F.col("doc_id").isNotNull()), ["doc_id", "key"])
    unnamed = hits.where(F.col("doc_id").isNull()).select("key")
    return _without(named.where(F.col("doc_id").isNull()), unnamed, ["key"]).select("row.*") \
        .union(named.where(F.col("doc_id").isNotNull()).select("row.*"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = secrets.secret_spans(docs.select(_row(docs), "text"))
    hit = F.size("secrets") > 0
    found = found.select("row", hit.alias("hit"), secrets.redacted(F.col("text"), F.col("secrets")).alias("clean"))
    chars = F.char_length("clean").cast(docs.schema["n_chars"].dataType)
    new = {"text": F.col("clean"), "n_chars": F.when(F.col("hit"), chars).otherwise(F.col("row.n_chars"))}
    return found.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark)
    # earlier stages leave their executors little memory: a smaller encoder cache, texts in smaller parts
    pieces = packing.pack(docs, tokenizer("word_bpe_49k.json"), cache_segments=150_000, chunk_bytes=1 << 20)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset", "loss_tokens")


STAGES = [
    ("language ID", language_stage),
    ("MinHash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("secret scans", secret_stage),
    ("packing", packing_stage),
]

#: Language models, tokenizers and bin packing have no SQL form; tests compare the run with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        path = scratch(spark, f"pipeline-{i}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
