"""Benchmark decontamination (operator 6), DataFrame functions only.

An item's windows are its runs of ``window`` consecutive words (the whole item
if it has fewer). A document holds a window when the words stand in it one
after the other. The join is prefix filtered: the words of a window are
ordered by their frequency in the documents, and as all of them must occur,
the rarest alone is its necessary prefix. So only document words that are some
window's rarest word become join rows, each with the few words around it; the
window must fit at that offset inside the document (length and position), and
its words must equal the document's (exact verification).

* null, empty or wordless texts and items: no words, no windows, no hits.
* items with null id mark words as hit but are not counted or listed; repeated
  items count once by id; equal windows of many items are joined once.
* repeated document rows: each its own result. Ties in frequency: by word.
* benchmark prefix words go into the scan's filter as a literal set, in blocks
  of ``block_words``; a larger benchmark takes more passes, not more memory.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourmart.llm.common import document_key, sized_broadcast, store
from hourmart.llm.words import words

WINDOW = 10
BLOCK_WORDS = 20_000


def item_windows(items: DataFrame, item_id: str, text: str, window: int = WINDOW) -> DataFrame:
    """(win array<string>, items array of distinct non-null ids): distinct windows."""
    w = F.col("w")
    n = F.size(w)
    wins = F.when(n >= F.lit(window), F.transform(
        F.sequence(F.lit(1), n - F.lit(window - 1)), lambda i: F.slice(w, i, window))).otherwise(F.array(w))
    return (items.select(F.col(item_id).alias("item"), words(F.col(text)).alias("w")).where(n > 0)
            .select("item", F.explode(wins).alias("win"))
            .groupBy("win").agg(F.collect_set("item").alias("items")))


def _in_blocks(values: list[str], size: int) -> list[list[str]]:
    return [values[i:i + size] for i in range(0, len(values), size)]


def document_words(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, key, w): the words of every document, written once and read by each later pass."""
    return store(docs.select(F.col(id_col), document_key(F.col(text)).alias("key"), words(F.col(text)).alias("w")),
                 "document-words")


def _counts(rows: DataFrame, vocabulary: DataFrame, block_words: int) -> DataFrame:
    """(word, count) of the vocabulary over the documents."""
    spark = rows.sparkSession
    parts = []
    for block in _in_blocks([r[0] for r in vocabulary.toLocalIterator()], block_words):
        parts.append(rows.select(F.explode(F.filter("w", lambda x: x.isin(block))).alias("word"))
                     .groupBy("word").count())
    if not parts:
        return spark.createDataFrame([], "word string, count long")
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def window_hits(rows: DataFrame, items: DataFrame, id_col: str = "doc_id",
                item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
                block_words: int = BLOCK_WORDS) -> DataFrame:
    """(id, key, start, size, items): every occurrence of a window in a document of ``document_words``;
    ``key`` is ``document_key`` of the text, ``start`` counts words from 0."""
    spark = rows.sparkSession
    wins = store(item_windows(items, item_id, item_text, window), "item-windows")
    vocabulary = wins.select(F.explode("win").alias("word")).distinct()
    counts = store(_counts(rows, vocabulary, block_words), "word-counts")
    # the rarest word of each window; a window with a word that no document has can't occur
    spots = (wins.select("win", "items", F.posexplode("win").alias("off", "word"))
             .join(counts, "word", "left")
             .groupBy("win").agg(F.min(F.struct(F.coalesce("count", F.lit(0)).alias("count"), "word", "off")).alias("m"),
                                 F.first("items").alias("items"))
             .where(F.col("m.count") > 0)
             .select("win", "items", F.col("m.word").alias("word"), F.col("m.off").alias("off"),
                     F.size("win").alias("size")))
    spots = store(spots, "window-prefixes")
    n = F.size("w")
    found: list[DataFrame] = []
    prefixes = spots.select("word").distinct()
    for block in _in_blocks([r[0] for r in prefixes.toLocalIterator()], block_words):
        places = F.filter(F.when(n > 0, F.sequence(F.lit(0), n - F.lit(1))),
                          lambda i: F.get(F.col("w"), i).isin(block))
        # each place with the words that a window around it can cover, from word ``low``
        around = F.transform(places, lambda p: F.struct(
            p.alias("at"), F.get(F.col("w"), p).alias("word"), F.greatest(p - F.lit(window - 1), F.lit(0)).alias("low"),
            F.slice(F.col("w"), F.greatest(p - F.lit(window - 1), F.lit(0)) + F.lit(1), 2 * window - 1).alias("near")))
        placed = rows.select(id_col, "key", n.alias("n"), F.explode(around).alias("c")) \
            .select(id_col, "key", "n", "c.*")
        probe = sized_broadcast(spots.where(F.col("word").isin(block)))
        start: Column = F.col("at") - F.col("off")
        found.append(placed.join(probe, "word")
                     .where((start >= 0) & (start + F.col("size") <= F.col("n")))
                     .where(F.slice("near", F.greatest(start - F.col("low") + F.lit(1), F.lit(1)), F.col("size")) == F.col("win"))
                     .select(id_col, "key", start.alias("start"), "size", "items"))
    if not found:
        kind = rows.schema[id_col].dataType.simpleString()
        ids = wins.schema["items"].dataType.simpleString()
        return spark.createDataFrame([], f"{id_col} {kind}, key long, start int, size int, items {ids}")
    out = found[0]
    for f in found[1:]:
        out = out.union(f)
    return out


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
                  block_words: int = BLOCK_WORDS) -> DataFrame:
    """id, key, n_words, n_hit (words inside an occurrence), items (ids, sorted as strings) of every row."""
    rows = document_words(docs, id_col, text)
    hits = window_hits(rows, items, id_col, item_id, item_text, window, block_words)
    # starts in order: each occurrence adds the words beyond what is covered so far
    covered = F.aggregate(
        F.array_sort("spans"), F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda st, s: F.struct(F.greatest(st["end"], s["start"] + s["size"]).alias("end"),
                               (st["n"] + F.greatest(F.lit(0), s["start"] + s["size"]
                                                     - F.greatest(st["end"], s["start"]))).alias("n")),
        lambda st: st["n"])
    per = (hits.groupBy(id_col, "key").agg(F.collect_set(F.struct("start", "size")).alias("spans"),
                                           F.array_distinct(F.flatten(F.collect_set("items"))).alias("ids"))
           .select(id_col, "key", covered.cast("long").alias("n_hit"),
                   F.array_sort(F.transform("ids", lambda x: x.cast("string"))).alias("items"))).alias("b")
    base = rows.select(id_col, "key", F.size("w").cast("long").alias("n_words")).alias("a")
    return base.join(per, (F.col("a.key") == F.col("b.key"))
                     & F.col(f"a.{id_col}").eqNullSafe(F.col(f"b.{id_col}")), "left") \
        .select(F.col(f"a.{id_col}").alias(id_col), F.col("a.key").alias("key"), "n_words",
                F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                F.coalesce("items", F.array().cast("array<string>")).alias("items"))
