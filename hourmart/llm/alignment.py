"""Alignment of two tokenizers' tokens by pointer jumping (operator 12).

Tokens of A and B cover the same bytes. Every token points to the token
overlapping it that reaches farthest right: the one of the other tokenizer
that holds its last byte, or itself where both end together. Doubling the
successors (``succ = succ[succ]``) until nothing changes takes every token of
a component to its last token, whose number labels the group; rounds grow with
the logarithm of the longest chain. All texts of a chunk are jumped at once.

A text is taken as a blank and the text. It is cut before single blanks
between visible characters, where A starts a new piece and no piece of B goes
on (checked on B's vocabulary and normaliser when it is loaded; otherwise a
text is not cut). Each distinct segment is encoded once per worker.

How often an id pair is linked is counted over the whole corpus. The counts of
the ``hot`` commonest pairs are broadcast to all documents' pairs; only links
of rarer pairs are shuffled, and none of those can be a hot key.

* null and empty texts, and texts that a tokenizer does not give back byte for
  byte, have no tokens: zeros, and '' as groups.
* repeated rows and ids: each row has its own result and counts for itself.
* empty table: no rows. Other columns are not read, whatever their names.
* very long texts are jumped ``RUN`` segments at a time: groups end at cuts.
"""

from __future__ import annotations

import hashlib
import itertools
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourmart.llm.common import BROADCAST_ROWS, store
from hourmart.llm.segments import split_chunks

#: Distinct segments kept per worker, bytes of text cut at once, segments jumped at once.
CACHE_SEGMENTS, CHUNK_BYTES, RUN = 500_000, 4 << 20, 400_000
#: An id pair's number (A id times B's vocabulary, plus B id) takes so many bits; the chunk's text the rest.
PAIR_BITS = 40


def farthest_tokens(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """The last token of each token's component; tokens are numbered A first, then B."""
    n = len(ends_a)
    holds = np.searchsorted(ends_a, ends_b)  # the A token with B's last byte
    after = np.where(ends_a[holds] > ends_b, holds, n + np.arange(len(ends_b)))
    succ = np.concatenate([n + np.searchsorted(ends_b, ends_a), after])
    while True:
        further = succ[succ]
        if (further == succ).all():
            return succ
        succ = further


def byte_level_table() -> dict[str, int]:
    """The character that a byte-level vocabulary writes for each byte: printable ones stand for themselves."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Side:
    """One tokenizer: ids of a list of segments, and the bytes of each id. Segments begin with a blank."""

    def __init__(self, path: str):
        self.pieces = path.endswith(".model")
        if self.pieces:
            import sentencepiece

            self._model = sentencepiece.SentencePieceProcessor(model_file=path)
            names = [self._model.id_to_piece(i) for i in range(self._model.vocab_size())]
            self.bytes = [bytes([int(p[3:5], 16)]) if self._model.is_byte(i) else p.replace("▁", " ").encode()
                          for i, p in enumerate(names)]
            self.cuts = b"identity" in self._model.serialized_model_proto()[-400:] \
                and not any(" " in p.replace("▁", " ").lstrip(" ") for p in names)
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            os.environ["RAYON_NUM_THREADS"] = "1"
            from tokenizers import Tokenizer

            self._model = Tokenizer.from_file(path)
            self._model.encode_special_tokens = True  # their strings in a text are plain text
            self._model.no_truncation()
            self._model.no_padding()
            level = byte_level_table()
            vocabulary = self._model.get_vocab(with_added_tokens=True)
            self.bytes = [b""] * (max(vocabulary.values()) + 1)
            for name, i in vocabulary.items():
                self.bytes[i] = bytes(level[c] for c in name) if all(c in level for c in name) else name.encode()
            self.cuts = True
        self.size = np.array([len(b) for b in self.bytes], np.int64)

    def encode(self, segments: list[str]) -> list[list[int]]:
        if self.pieces:  # the model puts the blank there itself
            return self._model.encode([s[1:] for s in segments], num_threads=1)
        return [e.ids for e in self._model.encode_batch_fast(segments, add_special_tokens=False)]


class _Known:
    """Ids of every segment seen, both ways, in flat arrays."""

    def __init__(self, sides: tuple[Side, Side]):
        self._sides = sides
        self._number: dict[str, int] = {}
        self.ids = [np.zeros(0, np.int64)] * 2
        self.end = [np.zeros(1, np.int64)] * 2
        self.sound = np.zeros(0, bool)

    def numbers(self, segments: list[str]) -> np.ndarray:
        if len(self._number) + len(segments) > CACHE_SEGMENTS:
            self.__init__(self._sides)
        missing = [s for s in segments if s not in self._number]
        sound, whole = np.ones(len(missing), bool), "".join(missing).encode()
        for k, side in enumerate(self._sides):
            found = side.encode(missing)
            size = np.fromiter(map(len, found), np.int64, len(found))
            flat = np.fromiter(itertools.chain.from_iterable(found), np.int64, int(size.sum()))
            if b"".join(map(side.bytes.__getitem__, flat.tolist())) != whole:  # then which of them
                for i, (s, ids) in enumerate(zip(missing, found)):
                    sound[i] &= b"".join([side.bytes[t] for t in ids]) == s.encode()
            self.ids[k] = np.concatenate([self.ids[k], flat])
            self.end[k] = np.concatenate([self.end[k], self.end[k][-1] + np.cumsum(size)])
        self.sound = np.concatenate([self.sound, sound])
        self._number.update(zip(missing, range(len(self._number), len(self._number) + len(missing))))
        return np.fromiter(map(self._number.__getitem__, segments), np.int64, len(segments))

    def flat(self, k: int, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of segments one after the other, and how many each has."""
        start, each = self.end[k][number], self.end[k][number + 1] - self.end[k][number]
        first = np.cumsum(each) - each
        return self.ids[k][np.repeat(start - first, each) + np.arange(each.sum())], each


def _segments(texts: pa.Array, cut: bool) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Segments of a blank and each text, and how many each text has."""
    texts = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts, pa.scalar("", pa.large_string()))
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    starts = offsets
    if cut and len(data) > 2:
        space = np.flatnonzero(data[1:-1] == 0x20) + 1
        before, before2, after = data[space - 1], data[np.maximum(space - 2, 0)], data[space + 1]
        # visible ASCII or a two-byte character from U+00C0 on, none of which is white space
        left = ((before > 0x20) & (before < 0x7F)) | ((before >= 0x80) & (before2 >= 0xC3) & (before2 <= 0xDF))
        right = ((after > 0x20) & (after < 0x7F)) | ((after >= 0xC3) & (after <= 0xDF))
        starts = np.sort(np.concatenate([offsets, space[left & right]]), kind="stable")
    starts = np.ascontiguousarray(starts, np.int64)
    pieces = pa.LargeStringArray.from_buffers(len(starts) - 1, pa.py_buffer(starts), pa.py_buffer(data))
    return pieces.dictionary_encode(), np.diff(np.searchsorted(starts, offsets))


class Aligner:
    """Groups, links and linked id pairs of texts."""

    def __init__(self, path_a: str, path_b: str):
        self.sides = Side(path_a), Side(path_b)
        self._known = _Known(self.sides)
        a, b = (np.arange(len(s.size)).astype(str) for s in self.sides)
        # every way a token can stand in the written groups: with what follows it
        self._written = pa.array(np.concatenate([np.char.add(a, ","), np.char.add(a, "|"),
                                                 np.char.add(b, ","), np.char.add(b, ";")]), pa.large_string())

    def _run(self, number: np.ndarray, text: np.ndarray) -> dict:
        """Tokens of a run of segments; ``text``: the text of each."""
        ids, ends, of = [], [], []
        for k in (0, 1):
            flat, each = self._known.flat(k, number)
            ids.append(flat)
            ends.append(np.cumsum(self.sides[k].size[flat]))
            of.append(np.repeat(text, each))
        n = len(ids[0]), len(ids[1])
        last = farthest_tokens(*ends) - n[0]  # a component's last token is B's, by its rule
        is_last = last[n[0]:] == np.arange(n[1])
        group = (np.cumsum(is_last) - 1)[last]
        in_group = [np.bincount(g, minlength=int(is_last.sum())) for g in (group[:n[0]], group[n[0]:])]
        below = [np.cumsum(c) - c for c in in_group]
        # order of writing: a group's A tokens, then its B tokens
        ga, gb = group[:n[0]], group[n[0]:]
        order = np.empty(sum(n), np.int64)
        order[np.arange(n[0]) + below[1][ga]] = ids[0] + len(self.sides[0].size) * \
            (np.arange(n[0]) == (below[0] + in_group[0] - 1)[ga])
        order[np.arange(n[1]) + (below[0] + in_group[0])[gb]] = ids[1] + 2 * len(self.sides[0].size) + \
            len(self.sides[1].size) * is_last
        # the stretches between neighbouring ends lie in one token of each: one stretch a link
        union = np.sort(np.concatenate(ends), kind="stable")
        union = union[np.diff(union, prepend=-1) > 0]
        la, lb = np.searchsorted(ends[0], union), np.searchsorted(ends[1], union)
        return {"n_a": of[0], "n_b": of[1], "n_groups": of[1][is_last], "n_links": of[0][la], "order": order,
                "pair": ids[0][la] * len(self.sides[1].size) + ids[1][lb]}

    def chunk(self, texts: pa.Array, keep: bool) -> dict:
        """Results of non-empty texts: counts and digests by text, and its linked pairs with their numbers."""
        n = len(texts)
        pieces, per_text = _segments(texts, all(s.cuts for s in self.sides))
        number = self._known.numbers(pieces.dictionary.to_pylist())[np.asarray(pieces.indices)]
        text = np.repeat(np.arange(n), per_text)
        sound = np.bincount(text[~self._known.sound[number]], minlength=n) == 0
        number, text = number[sound[text]], text[sound[text]]
        out = {c: np.zeros(n, np.int64) for c in ("n_a", "n_b", "n_groups", "n_links")}
        digest = [hashlib.sha256() if s else None for s in sound]
        groups: list[list] = [[] for _ in range(n)] if keep else []
        pairs, at_text, times = [], [], []
        for at in range(0, len(number), RUN):
            run = self._run(number[at:at + RUN], text[at:at + RUN])
            for c in out:
                out[c] += np.bincount(run[c], minlength=n)
            written = self._written.take(pa.array(run["order"]))
            stop = np.frombuffer(written.buffers()[1], np.int64)[:len(written) + 1]
            # the separator after a text's last group stands between runs only
            tokens = np.bincount(run["n_a"], minlength=n) + np.bincount(run["n_b"], minlength=n)
            upto = np.cumsum(tokens)
            blob = memoryview(written.buffers()[2])
            for t in np.flatnonzero(tokens):
                lo, hi = stop[upto[t] - tokens[t]], stop[upto[t]]
                goes_on = at + RUN < len(number) and text[at + RUN] == t
                part = blob[lo:hi if goes_on else hi - 1]
                digest[t].update(part)
                if keep:
                    groups[t].append(bytes(part))
            key, seen = np.unique((run["n_links"] << PAIR_BITS) | run["pair"], return_counts=True)
            at_text.append(key >> PAIR_BITS)
            pairs.append(key & ((1 << PAIR_BITS) - 1))
            times.append(seen)
        out["digest"] = [d.hexdigest() if d else "" for d in digest]
        if keep:
            out["groups"] = [b"".join(g).decode() for g in groups]
        none = [np.zeros(0, np.int64)]
        out["pairs"], out["times"] = np.concatenate(pairs or none), np.concatenate(times or none)
        out["ends"] = np.cumsum(np.bincount(np.concatenate(at_text or none), minlength=n))
        return out


def _align_rows(path_a: str, path_b: str, keep: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, row = None, TaskContext.get().partitionId() << 40
        for b in batches:
            aligner = aligner or Aligner(path_a, path_b)
            texts = b.column("text").cast(pa.large_string())
            for lo, hi in split_chunks(texts, CHUNK_BYTES):
                part = texts.slice(lo, hi - lo)
                there = np.flatnonzero(np.asarray(pc.fill_null(pc.binary_length(part), 0)) > 0)
                got = aligner.chunk(part.take(pa.array(there)), keep) if len(there) else None

                def spread(name: str) -> np.ndarray:
                    full = np.zeros(hi - lo, np.int64)
                    if got:
                        full[there] = got[name]
                    return full

                def strings(name: str) -> list[str]:
                    full = [""] * (hi - lo)
                    for i, s in zip(there, got[name] if got else []):
                        full[i] = s
                    return full

                size = np.zeros(hi - lo, np.int64)
                if got:
                    size[there] = np.diff(got["ends"], prepend=0)
                ends = pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32))
                columns = {"row": pa.array(np.arange(row, row + hi - lo)), "id": b.column("id").slice(lo, hi - lo),
                           **{c: pa.array(spread(c)) for c in ("n_a", "n_b", "n_groups", "n_links")},
                           "groups_sha256": pa.array(strings("digest"), pa.string()),
                           "groups": pa.array(strings("groups") if keep else [None] * (hi - lo), pa.string()),
                           "pairs": pa.ListArray.from_arrays(ends, pa.array(got["pairs"] if got else [], pa.int64())),
                           "times": pa.ListArray.from_arrays(ends, pa.array(got["times"] if got else [], pa.int64()))}
                row += hi - lo
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))
    return run


def _sums(links: DataFrame, scored: DataFrame, how: str = "inner") -> DataFrame:
    return (links.join(scored, "pair", how).groupBy("row")
            .agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(F.lit(0))).alias("n_best"),
                 F.sum(F.col("times") * F.col("count")).alias("count_sum")))


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text: str = "text",
          keep_groups: bool = False, hot: int = BROADCAST_ROWS) -> DataFrame:
    """id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 (and ``groups`` if kept) of every row.

    Groups are written as ``a1,a2|b1;a3|b2,b3``. ``n_best``: links whose id pair is the commonest of its B id
    in the corpus (ties included); ``count_sum``: the corpus counts of all links added up.
    ``hot``: rows broadcast at most.
    """
    vocabulary_b = len(Side(path_b).size)
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = store(docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).mapInArrow(
        _align_rows(path_a, path_b, keep_groups),
        f"row long, id {id_type}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string, "
        "pairs array<long>, times array<long>"), "alignments", compression="zstd")
    links = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("l")) \
        .select("row", F.col("l.pairs").alias("pair"), F.col("l.times").alias("times"))
    counts = store(links.groupBy("pair").agg(F.sum("times").alias("count")), "pair-counts")
    b_id = F.pmod("pair", F.lit(vocabulary_b))
    most = counts.groupBy(b_id.alias("b")).agg(F.max("count").alias("most"))  # at most vocabulary_b rows
    most = F.broadcast(most) if vocabulary_b <= BROADCAST_ROWS else most
    scored = store(counts.withColumn("b", b_id).join(most, "b")
                   .select("pair", "count", (F.col("count") == F.col("most")).alias("best")), "scored-pairs")
    n = scored.count()
    if n <= hot:
        sums = _sums(links, F.broadcast(scored))
    else:
        least = scored.select(F.percentile_approx("count", 1.0 - hot / (2.0 * n), 10_000).alias("c")).first()["c"]
        common, rare = scored.where(F.col("count") > least), scored.where(F.col("count") <= least)
        common = F.broadcast(common) if common.count() <= hot else common
        sums = _sums(links, common).union(_sums(links.join(common, "pair", "left_anti"), rare)) \
            .groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    out = rows.drop("pairs", "times").join(sums, "row", "left")
    return out.select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links",
                      *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")],
                      "groups_sha256", *(["groups"] if keep_groups else []))
