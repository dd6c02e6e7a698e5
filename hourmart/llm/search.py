"""Ranked lexical search by norm buckets (operator 13).

A document is a vector of impacts over the terms the items ask for, an item a
vector of term weights; the score is their product. Weights are shared out by
their square roots to both sides, so that common terms add little length.

1. One pass keeps of every document its length and its counts of asked terms;
   document frequencies, N and L are aggregates over all documents.
2. Vectors are ordered by length across the cluster (range exchange on length
   and a hash, so that equal lengths can be cut) and stored.
3. The longest part is searched first. It gives every item a score that its
   ``k`` best reach at least; the rest is searched with these thresholds.
4. A task reads its vectors, longest first, in buckets. Cauchy-Schwarz prunes
   whole buckets for an item, and within a bucket the vectors too short for it.
   Where the threshold is high enough for an item's strongest terms to have a
   positive lower coordinate bound, only vectors within the bounds of these
   coordinates stay. Survivors of the real-valued product are scored again
   exactly in 64-bit integers; the task keeps ``k`` of an item.

Pruning is strict and has a margin for rounding, so no score or tie is lost.
Items are taken in blocks of about ``BLOCK_ENTRIES`` (item, term) rows, which
bounds what is broadcast; a larger query set takes more passes.

* terms are runs of ASCII letters, digits and non-ASCII characters, A-Z
  lower-cased; null and empty texts have none, and items without terms no rows.
* rows with one item_id (null included) are one item, their terms added.
* each document row is ranked for itself, so a repeated one takes several
  ranks; equal scores go by ascending id, null last, then in no set order
  (such rows are equal in all columns).
* empty tables: no rows. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hourmart.llm.common import store
from hourmart.llm.words import words

#: (item, term) rows broadcast at once; vectors in a bucket; strongest terms whose bounds are tried.
BLOCK_ENTRIES, BUCKET, FOCUS = 500_000, 4096, 3
#: The part of the vectors searched first, for thresholds.
FIRST_PART = 1 / 32
MARGIN = 1e-9

# every byte that is in no term becomes a blank, A-Z become a-z
_TERMS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))


def _counted(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {t: i for i, t in enumerate(vocabulary.value)}
        for b in batches:
            size, ends, terms, times = [], [0], [], []
            for text in b.column("text"):
                found = text.as_buffer().to_pybytes().translate(_TERMS).split() if text.is_valid else []
                mine = Counter(filter(None.__ne__, map(known.get, found)))
                size.append(len(found))
                terms.extend(mine.keys())
                times.extend(mine.values())
                ends.append(len(terms))
            at = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(size, pa.int64()), pa.ListArray.from_arrays(at, pa.array(terms, pa.int32())),
                 pa.ListArray.from_arrays(at, pa.array(times, pa.int64()))], ["id", "n", "terms", "times"])
    return run


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column one after the other, and the rows they are of."""
    size = np.asarray(column.value_lengths())
    return np.asarray(column.flatten()), np.repeat(np.arange(len(column)), size)


def impact(times: np.ndarray, n: np.ndarray, docs: int, length: int) -> np.ndarray:
    m = 100 - 25 + (25 * n * docs) // length
    return (1_000_000_000 * times) // (1000 * times + 12 * m)


def _vectors(weight, docs: int, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            term, row = _flat(b.column("terms"))
            x = impact(_flat(b.column("times"))[0], np.asarray(b.column("n"))[row], docs, length)
            norm = np.sqrt(np.bincount(row, weight.value[term] * x.astype(float) ** 2, b.num_rows))
            at = b.column("terms").value_lengths().to_numpy()
            ends = pa.array(np.concatenate([[0], np.cumsum(at)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(norm), pa.ListArray.from_arrays(ends, pa.array(term, pa.int32())),
                 pa.ListArray.from_arrays(ends, pa.array(x, pa.int64()))], ["id", "norm", "terms", "x"])
    return run


class Items:
    """The items of a block: their terms, weights (times the repeats) and lengths."""

    def __init__(self, item: np.ndarray, term: np.ndarray, times: np.ndarray, weight: np.ndarray, n_items: int):
        order = np.argsort(item, kind="stable")
        self.end = np.searchsorted(item[order], np.arange(n_items + 1))
        self.term = term[order]
        self.q = times[order] * weight[self.term]
        self.root = np.sqrt(weight.astype(float))  # a document's coordinate is its impact times this
        self.real = times[order] * self.root[self.term]
        self.norm = np.sqrt(np.add.reduceat(np.append(self.real ** 2, 0.0), self.end[:-1]))


class Best:
    """The ``k`` best (score, id) of an item so far, and the score that another must reach."""

    def __init__(self, k: int, least: int):
        self.k, self.least = k, least
        self.score, self.id = np.zeros(0, np.int64), None

    def add(self, score: np.ndarray, ids: pa.Array) -> None:
        good = score >= max(self.least, 1)
        if good.sum() > self.k:  # ties of the k-th stay
            good &= score >= np.partition(score, -self.k)[-self.k]
        score, ids = score[good], ids.filter(pa.array(good))
        if not len(score):
            return
        if self.id is not None:
            score, ids = np.concatenate([self.score, score]), pa.concat_arrays([self.id, ids])
        null = np.asarray(ids.is_null())
        plain = ids.fill_null("" if pa.types.is_string(ids.type) else 0).to_numpy(zero_copy_only=False)
        if plain.dtype == object:
            plain = plain.astype(str)
        order = np.lexsort((plain, null, -score))[:self.k]
        self.score, self.id = score[order], ids.take(pa.array(order))
        if len(order) == self.k:
            self.least = max(self.least, int(self.score[-1]))


def coordinate_bounds(q: np.ndarray, least_cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Between what a unit vector's coordinates must lie for a cosine of ``least_cosine`` with unit vector q."""
    c = min(1.0, max(0.0, least_cosine))
    side = np.sqrt(np.maximum(0.0, 1 - q * q) * (1 - c * c))
    return q * c - side, np.where(q < c, q * c + side, 1.0)


def search_bucket(items: Items, best: list[Best], ids: pa.Array, norm: np.ndarray, term: np.ndarray, row: np.ndarray,
                  x: np.ndarray) -> None:
    """Add a bucket's vectors, in descending order of ``norm``, to the items' best."""
    least = np.array([b.least for b in best], float) * (1 - MARGIN)
    live = np.flatnonzero(items.norm * norm[0] >= least)
    if not len(live):
        return
    order = np.argsort(term, kind="stable")
    term, row, x = term[order], row[order], x[order]
    real = x * items.root[term]
    for i in live:
        mine = slice(items.end[i], items.end[i + 1])
        if not items.norm[i]:
            continue
        terms, q, real_q = items.term[mine], items.q[mine], items.real[mine]
        lo, hi = np.searchsorted(term, terms, "left"), np.searchsorted(term, terms, "right")
        stays = items.norm[i] * norm >= least[i]
        strong = np.argsort(-real_q)[:FOCUS]
        low, high = coordinate_bounds(real_q[strong] / items.norm[i], least[i] / (items.norm[i] * norm[0]))
        for f, a, b in zip(strong, low, high):
            if a <= MARGIN:
                continue
            at = slice(lo[f], hi[f])
            share = real[at] / norm[row[at]]
            inside = np.zeros(len(norm), bool)
            inside[row[at][(share >= a - MARGIN) & (share <= b + MARGIN)]] = True
            stays &= inside
        if not stays.any():
            continue
        each = hi - lo
        every = np.repeat(lo - (np.cumsum(each) - each), each) + np.arange(each.sum())
        at_row = row[every]
        about = np.bincount(at_row, real[every] * np.repeat(real_q, each), len(norm))
        stays &= (about > 0) & (about >= least[i])
        if not stays.any():
            continue
        left = stays[at_row]
        score = np.zeros(len(norm), np.int64)
        np.add.at(score, at_row[left], (x[every] * np.repeat(q, each))[left])
        found = np.flatnonzero(stays)
        best[i].add(score[found], ids.take(pa.array(found)))


def _searched(block, k: int, names: list):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, least = block.value
        best = [Best(k, n) for n in least]
        for b in batches:
            for at in range(0, b.num_rows, BUCKET):
                part = b.slice(at, BUCKET)
                norm = np.asarray(part.column("norm"))
                order = pa.array(np.argsort(-norm, kind="stable"))
                part = part.take(order)
                term, row = _flat(part.column("terms"))
                search_bucket(items, best, part.column("id"), np.asarray(part.column("norm")), term, row,
                              _flat(part.column("x"))[0])
        for i, got in enumerate(best):
            if len(got.score):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(got.score), i), pa.int64()), got.id, pa.array(got.score)], ["item", "id", "score"])
    return run


def _top(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _rank_block(docs: DataFrame, asked: DataFrame, id_type: str, k: int, first_part: float) -> DataFrame:
    """(item_id, rank, id, score) of one block of items; ``asked``: item_id, term, times."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    item_type = asked.schema["item_id"].dataType.simpleString()
    schema = f"item_id {item_type}, rank int, id {id_type}, score long"
    rows = asked.toArrow()
    if not rows.num_rows:
        return spark.createDataFrame([], schema)
    vocabulary, term = np.unique(rows["term"].to_numpy().astype(str), return_inverse=True)
    name = rows["item_id"].combine_chunks().dictionary_encode("encode")
    names, item = name.dictionary.to_pylist(), np.asarray(name.indices, np.int64)
    counted = store(docs.mapInArrow(_counted(sc.broadcast([t.encode() for t in vocabulary])),
                                    f"id {id_type}, n long, terms array<int>, times array<long>"), "counted-terms")
    total = counted.where("n > 0").agg(F.count("*").alias("docs"), F.sum("n").alias("length")).first()
    if not total["docs"]:
        return spark.createDataFrame([], schema)
    df = counted.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df")).toPandas()
    frequency = np.zeros(len(vocabulary), np.int64)
    frequency[df["t"].to_numpy(np.int64)] = df["df"]
    weight = np.floor(1000 * np.log((2 * total["docs"] + 2) / (2 * frequency + 1))).astype(np.int64)
    weights = sc.broadcast(weight)
    vectors = counted.where(F.size("terms") > 0).select("id", "n", "terms", "times").mapInArrow(
        _vectors(weights, total["docs"], total["length"]), f"id {id_type}, norm double, terms array<int>, x array<long>") \
        .where("norm > 0")
    vectors = store(vectors.repartitionByRange(F.col("norm").desc(), F.xxhash64("id", "terms"))
                    .sortWithinPartitions(F.col("norm").desc()), "vectors", compression="zstd")
    cut = vectors.agg(F.percentile_approx("norm", 1 - first_part, 1000).alias("c")).first()["c"]
    if cut is None:
        return spark.createDataFrame([], schema)
    items = Items(item, term, rows["times"].to_numpy(), weight, len(names))
    out = f"item long, id {id_type}, score long"
    start = sc.broadcast((items, np.zeros(len(names), np.int64)))
    longest = store(vectors.where(F.col("norm") >= F.lit(cut)).mapInArrow(_searched(start, k, names), out), "longest")
    least = np.zeros(len(names), np.int64)
    for r in _top(longest, k).where(F.col("rank") == k).select("item", "score").collect():
        least[r["item"]] = r["score"]
    rest = sc.broadcast((items, least))
    found = longest.union(vectors.where(F.col("norm") < F.lit(cut)).mapInArrow(_searched(rest, k, names), out))
    named = spark.createDataFrame([(i, n) for i, n in enumerate(names)],
                                  f"item long, item_id {item_type}")
    return _top(found, k).join(F.broadcast(named), "item").select("item_id", "rank", "id", "score")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text: str = "text",
                  item_col: str = "item_id", item_text: str = "text", block_entries: int = BLOCK_ENTRIES,
                  first_part: float = FIRST_PART) -> DataFrame:
    """item id, rank (from 1), document id and score of each item's ``k`` best documents with a score above 0."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    id_type = source.schema["id"].dataType.simpleString()
    asked = store(items.select(F.col(item_col).alias("item_id"), F.explode(words(F.col(item_text))).alias("term"))
                  .groupBy("item_id", "term").agg(F.count("*").alias("times")), "asked-terms")
    blocks = max(1, -(-asked.count() // block_entries))
    of = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    ranked = None
    for b in range(blocks):
        part = _rank_block(source, asked.where(of == b) if blocks > 1 else asked, id_type, k, first_part)
        ranked = part if ranked is None else ranked.union(part)
    return ranked.select(F.col("item_id").alias(item_col), "rank", F.col("id").alias(id_col), "score")
