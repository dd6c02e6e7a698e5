"""Language ID by prediction by partial matching (operator 3).

Per language a byte context tree of order ``order``: how often each byte
followed each context of 0 to ``order`` bytes. A byte's code length is
-log2(n / (N + T)) at the longest context in which it was seen (n times, N
bytes and T distinct bytes seen there), plus -log2(T / (N + T)) for every
longer context that was left by an escape, down to 8 bits for a byte never
seen. The statistics are frozen after training, so a text's code length is the
exact sum over its bytes, and the language with the shortest one is
predicted. Texts are lower-cased first and start after a line break.

The trees are fitted on a bounded sample of labelled rows: about ``sample``
texts per language, of at most ``sample_bytes`` each, picked by a hash of the
text. The table of the trees is what is sent to the executors; its size is
bounded by sample * sample_bytes * languages.

* null text or no letter in it: ``und``, score 0. No training rows: all ``und``.
* empty table: no rows. Repeated rows: each its own result. Ties: the first
  language by name. Very long texts are scored in chunks, whole.
* labels, sources and ids are never read when predicting.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourmart.llm.segments import split_chunks

ORDER = 4
SAMPLE = 500
SAMPLE_BYTES = 16_384
#: Contexts of three bytes and more keep only bytes seen at least so often there.
LEAST_SEEN = 2
#: Bytes of text handled at once, and how many of them are looked up together: a look-up holds some hundred bytes for each.
CHUNK = 1 << 20
PIECE = 1 << 17


def _lowered(text: Column) -> Column:
    return F.lower(text).cast("binary")


def _grams(data: np.ndarray, order: int) -> np.ndarray:
    """For each byte, it and the ``order`` bytes before it, as one integer (the byte last)."""
    out = np.zeros(len(data) - order, np.uint64)
    for k in range(order + 1):
        out = (out << np.uint64(8)) | data[k:len(data) - order + k]
    return out


def _padded(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """The texts behind line breaks, and their sizes with them."""
    pad = b"\n" * order
    data = np.frombuffer(b"".join(pad + t for t in texts), np.uint8)
    return data, np.array([len(t) + order for t in texts], np.int64)


def _count_grams(order: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = (b.slice(a, z - a) for b in batches for a, z in split_chunks(b.column("text"), CHUNK))
        for b in parts:
            langs = b.column("lang").to_pylist()
            texts = b.column("text").to_pylist()
            for lang in sorted(set(langs)):
                data, size = _padded([t for t, x in zip(texts, langs) if x == lang], order)
                keep = np.ones(len(data), bool)
                starts = np.cumsum(size) - size
                for k in range(order):
                    keep[starts + k] = False
                full = _grams(data, order)[keep[order:]]
                for d in range(order + 1):
                    gram, n = np.unique(full & np.uint64((1 << 8 * (d + 1)) - 1), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(gram)), pa.array(np.full(len(gram), d, np.int32)),
                         pa.array(gram.view(np.int64)), pa.array(n)], ["lang", "depth", "gram", "n"])
    return count


class _Table:
    """Rows of floats by integer key: one multiplicative hash, linear probing."""

    def __init__(self, keys: np.ndarray, rows: np.ndarray):
        self.bits = max(10, int(len(keys) * 3).bit_length())
        self.keys, self.rows = np.append(keys, np.uint64(0)), np.vstack([rows, np.zeros((1, rows.shape[1]))])
        self.slots = np.full(1 << self.bits, -1, np.int32)
        todo, at, self.reach = np.arange(len(keys)), self._slot(keys), 0
        while len(todo):
            self.reach += 1
            free = self.slots[at] < 0
            self.slots[at[free]] = todo[free]  # of several for one slot the last stays
            left = self.slots[at] != todo
            todo, at = todo[left], (at[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, -1 where there is none."""
        at = self._slot(keys)
        row = self.slots[at]
        row[self.keys[row] != keys] = -1
        todo = np.flatnonzero(row < 0)
        for step in range(1, self.reach):
            if not len(todo):
                break
            slot = (at[todo] + step) & ((1 << self.bits) - 1)
            got = self.slots[slot]
            hit = (got >= 0) & (self.keys[got] == keys[todo])
            row[todo[hit]] = got[hit]
            todo = todo[~hit & (got >= 0)]  # an empty slot ends the search
        return row


class ContextTrees:
    """Frozen statistics of all languages: code lengths by (context, byte) and escapes by context, per depth."""

    def __init__(self, languages: list[str], counts: dict[int, tuple[np.ndarray, np.ndarray]]):
        """``counts``: by depth, the distinct (context, byte) integers and their counts per language."""
        self.languages, self.order = languages, max(counts, default=-1)
        self.cost: list[_Table] = []
        self.escape: list[_Table] = []
        for depth in range(self.order + 1):
            gram, n = counts[depth]
            context, where = np.unique(gram >> np.uint64(8), return_inverse=True)
            total = np.zeros((len(context), len(languages)))
            kinds = np.zeros_like(total)
            np.add.at(total, where, n)
            np.add.at(kinds, where, n > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(total > 0, -np.log2(kinds / (total + kinds)), 0.0)
                seen = -np.log2(n / (total + kinds)[where])
            shorter = self.bits(gram, depth - 1)
            self.cost.append(_Table(gram, np.where(n > 0, seen, escape[where] + shorter)))
            self.escape.append(_Table(context, escape))

    def bits(self, gram: np.ndarray, depth: int | None = None) -> np.ndarray:
        """Code length of each byte in each language, from its context of ``depth`` bytes down."""
        depth = self.order if depth is None else depth
        out = np.zeros((len(gram), len(self.languages)))
        todo = np.arange(len(gram))
        for d in range(depth, -1, -1):
            part = gram[todo] & np.uint64((1 << 8 * (d + 1)) - 1)
            row = self.cost[d].find(part)
            if d == depth and (row >= 0).all():
                return self.cost[d].rows[row]
            hit = row >= 0
            out[todo[hit]] += self.cost[d].rows[row[hit]]
            todo, part = todo[~hit], part[~hit]
            if not len(todo):
                return out
            left = self.escape[d].find(part >> np.uint64(8))
            out[todo] += self.escape[d].rows[left]  # row -1 holds zeros: a context never seen costs no escape
        out[todo] += 8.0
        return out

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each text in each language."""
        out = np.zeros((len(texts), len(self.languages)))
        if not texts:
            return out
        data, size = _padded(texts, self.order)
        text_of = np.repeat(np.arange(len(texts), dtype=np.int32), size)
        keep = np.ones(len(data), bool)
        starts = np.cumsum(size) - size
        for k in range(self.order):
            keep[starts + k] = False
        for at in range(self.order, len(data), PIECE):
            end = min(at + PIECE, len(data))
            bits = self.bits(_grams(data[at - self.order:end], self.order))
            bits[~keep[at:end]] = 0.0
            first, last = text_of[at], text_of[end - 1]
            for i in range(len(self.languages)):
                out[first:last + 1, i] += np.bincount(text_of[at:end] - first, bits[:, i], last - first + 1)
        return out


def fit(docs: DataFrame, where: Column, text: str = "text", lang: str = "lang", order: int = ORDER,
        sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES, least_seen: int = LEAST_SEEN) -> ContextTrees:
    """Context trees of the languages of the rows of ``docs`` for which ``where`` holds."""
    rows = docs.where(where & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), (F.octet_length(text) > sample_bytes).alias("long"),
        F.xxhash64(text).alias("hash"))
    # distinct texts, two rows per language; which texts are sampled depends on nothing but their hash
    n = {(r["lang"], r["long"]): r["count"]
         for r in rows.select("lang", "long", "hash").distinct().groupBy("lang", "long").count().collect()}
    share = F.lit(0.0)
    for (name, is_long), total in n.items():
        if not is_long or (name, False) not in n:
            share = F.when((F.col("lang") == F.lit(name)) & (F.col("long") == F.lit(is_long)),
                           F.lit(min(1.0, sample / total))).otherwise(share)
    picked = (rows.where(F.pmod("hash", F.lit(1 << 30)) < share * F.lit(float(1 << 30)))
              .select("lang", F.substring("text", 1, sample_bytes).alias("text"))
              .dropDuplicates(["lang", "text"]).select("lang", _lowered(F.col("text")).alias("text")))
    # the bounded sample is counted in a few tasks: each returns its distinct grams
    found = (picked.repartition(2 * max(1, len({name for name, _ in n})))
             .mapInArrow(_count_grams(order), "lang string, depth int, gram long, n long")
             .groupBy("lang", "depth", "gram").agg(F.sum("n").alias("n"))
             .where((F.col("n") >= least_seen) | (F.col("depth") < 3)).toPandas())
    languages = sorted(found["lang"].unique())
    counts = {}
    for depth in range(order + 1) if languages else ():
        part = found[found["depth"] == depth]
        gram, where_at = np.unique(part["gram"].to_numpy().view(np.uint64), return_inverse=True)
        table = np.zeros((len(gram), len(languages)))
        table[where_at, np.searchsorted(languages, part["lang"].to_numpy().astype(str))] = part["n"]
        counts[depth] = (gram, table)
    return ContextTrees(languages, counts)


def predict(docs: DataFrame, trees: ContextTrees, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score (posterior of the predicted language under equal priors) and
    bits_per_byte (its code length)."""
    docs = docs.drop("lang_pred", "score", "bits_per_byte")
    if not trees.languages:
        return docs.withColumn("lang_pred", F.lit("und")).withColumn("score", F.lit(0.0)) \
            .withColumn("bits_per_byte", F.lit(8.0))
    model = docs.sparkSession.sparkContext.broadcast(trees)

    @F.pandas_udf("lang string, score double, bits double")
    def guess(texts):
        import pandas as pd

        values = [t or b"" for t in texts]
        parts, at = [np.zeros((0, len(model.value.languages)))], 0
        while at < len(values):  # some texts at a time, by their bytes
            end, held = at, 0
            while end < len(values) and (end == at or held + len(values[end]) <= CHUNK):
                held += len(values[end])
                end += 1
            parts.append(model.value.code_lengths(values[at:end]))
            at = end
        bits = np.vstack(parts)
        best = bits.argmin(axis=1)
        least = bits.min(axis=1)
        odds = np.exp2(-np.minimum(bits - least[:, None], 1000.0)).sum(axis=1)
        size = np.array([max(len(v), 1) for v in values])
        return pd.DataFrame({"lang": np.array(model.value.languages, dtype=object)[best],
                             "score": 1.0 / odds, "bits": least / size})

    known = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    g = F.col("_guess")
    return (docs.withColumn("_guess", guess(_lowered(F.col(text))))
            .withColumn("lang_pred", F.when(known, g["lang"]).otherwise(F.lit("und")))
            .withColumn("score", F.when(known, g["score"]).otherwise(F.lit(0.0)))
            .withColumn("bits_per_byte", g["bits"]).drop("_guess"))
