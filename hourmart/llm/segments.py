"""Exact tokenization of whole texts through a cache of text segments.

A byte-level or word-level BPE never forms a token across a single blank or
line feed that stands between two visible characters, nor between a letter and
an ASCII mark other than ``'`` and ``|``: both pre-tokenizers start a new piece
there, and special strings hold neither. So a text's ids are the ids of its
segments, cut before such characters, one after the other. The segments of a
batch repeat often; each distinct one is encoded once.

Cuts are made on UTF-8 bytes. The character on either side of the space must
be ASCII 0x21-0x7E or a two-byte character from U+00C0 on, none of which is
white space; the letter before a mark must be in A-Z, a-z or U+00C0-U+027F
(less two signs and one letter).
Anywhere else there is no cut and the segment is just longer.

The tokenizer's file tells its form. A segment that is one word of Latin
letters is one piece to the library's BPE model, which is then called on it
directly. A tokenizer that lower-cases and drops white space gets its segments
folded first, so that ``Word``, `` word`` and a line's first ``word`` are one.
A capital before anything but ASCII or a Latin-1 letter stays (a mark after it
may compose differently), and so do all in a chunk that holds ``<|``, where
case decides whether a string is special.
"""

from __future__ import annotations

import itertools
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Distinct segments kept per Python worker before the cache starts again.
CACHE_SEGMENTS = 700_000
#: Bytes of text handled at once.
CHUNK_BYTES = 8 << 20


_STOP, _LETTER = np.zeros(256, bool), np.zeros(256, bool)
_STOP[list(b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{}~")] = True
_LETTER[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = True
_LATIN = "A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF"


def _cut_offsets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All segment starts of the concatenated texts, the texts' own starts included, and those at a space."""
    if len(data) < 3:
        return np.unique(offsets), np.zeros(0, np.int64)
    space = np.flatnonzero((data[1:-1] == 0x20) | (data[1:-1] == 0x0A)) + 1
    before, after = data[space - 1], data[space + 1]
    before2 = data[np.maximum(space - 2, 0)]
    left = ((before > 0x20) & (before < 0x7F)) | ((before >= 0x80) & (before2 >= 0xC3) & (before2 <= 0xDF))
    right = ((after > 0x20) & (after < 0x7F)) | ((after >= 0xC3) & (after <= 0xDF))
    space = space[left & right]
    stop = np.flatnonzero(_STOP[data[1:]]) + 1
    before, before2 = data[stop - 1], data[np.maximum(stop - 2, 0)]
    letter = _LETTER[before] | ((before >= 0x80) & (before2 >= 0xC3) & (before2 <= 0xC9)
                                & ~((before2 == 0xC3) & ((before == 0x97) | (before == 0xB7)))  # signs U+00D7, U+00F7
                                & ~((before2 == 0xC4) & (before == 0xB0)))  # U+0130: its lower case ends in a mark
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = cut[space] = cut[stop[letter]] = True
    return np.flatnonzero(cut), space


def _fold(data: np.ndarray, space: np.ndarray) -> np.ndarray:
    """``data`` in lower case where that changes no id, with a blank for the line feeds cut at."""
    data = data.copy()
    data[space] = 0x20
    if b"<|" not in data.tobytes():
        after = np.append(data[1:], np.uint8(0))
        data[(data >= 0x41) & (data <= 0x5A) & ((after < 0x80) | (after == 0xC3))] += 0x20
    return data


def _form(path: str) -> str:
    """``bytes``: a blank goes with its word. ``words``: lower case, white space dropped. Else empty."""
    with open(path, encoding="utf-8") as f:
        d = json.load(f)
    if d["model"]["type"] != "BPE" or not d["pre_tokenizer"] or d["model"].get("dropout"):
        return ""
    normal, before = d["normalizer"], d["pre_tokenizer"]
    steps = [n["type"] for n in normal.get("normalizers", [])] if normal else []
    pieces = [p["type"] for p in before.get("pretokenizers", [])]
    if not normal and before["type"] == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"]:
        return "bytes"
    if steps == ["NFC", "Replace", "Lowercase"] and pieces == ["Split", "ByteLevel"]:
        split, level = before["pretokenizers"]
        if split["behavior"] == "Removed" and split["invert"] and "[\\p{L}]+" in split["pattern"]["Regex"] \
                and not level["use_regex"] and not level["add_prefix_space"]:
            return "words"
    return ""


def split_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a string column with about ``limit`` bytes each; a longer text stands alone."""
    size = np.asarray(pc.fill_null(pc.binary_length(column), 0), dtype=np.int64)
    start, total = 0, 0
    for i, n in enumerate(size):
        if total and total + n > limit:
            yield start, i
            start, total = i, 0
        total += int(n)
    if start < len(size):
        yield start, len(size)


class SegmentEncoder:
    """Token counts and ids of whole texts, equal to the library's ``encode`` without added special tokens."""

    def __init__(self, tokenizer_path: str, cache_segments: int = 0, chunk_bytes: int = 0):
        self._most, self._chunk = cache_segments or CACHE_SEGMENTS, chunk_bytes or CHUNK_BYTES
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        os.environ["RAYON_NUM_THREADS"] = "1"
        from tokenizers import Tokenizer, pre_tokenizers

        self._form = _form(tokenizer_path)
        self._word = re.compile(f" ?[{_LATIN}]+").fullmatch
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        letters = " " + "".join(chr(c) for c in range(0xC0, 0x100))
        self._level = {ord(c): level.pre_tokenize_str(c)[0][0] for c in letters}  # as the model spells these bytes
        self._tokenizer = Tokenizer.from_file(tokenizer_path)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        self._forget()

    def _forget(self) -> None:
        self._known: dict[str, int] = {}  # segment -> its number
        self._ids, self._end = np.zeros(0, np.uint32), np.zeros(1, np.int64)  # all ids, and where each number's end

    def _segments(self, column: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
        """The segments of all texts, and how many segments each text has."""
        column = pc.fill_null(column.cast(pa.large_string()), "")
        column = pa.concat_arrays([column])  # offsets from 0
        n = len(column)
        offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + n + 1]
        raw = column.buffers()[2]
        data = np.frombuffer(raw, dtype=np.uint8)[offsets[0]:offsets[-1]] if raw else np.zeros(0, np.uint8)
        offsets = offsets - offsets[0]
        cuts, space = _cut_offsets(data, offsets)
        if self._form == "words":
            data = _fold(data, space)
        if cuts[-1] != len(data):
            cuts = np.append(cuts, len(data))
        cuts = np.ascontiguousarray(cuts, dtype=np.int64)
        pieces = pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts), pa.py_buffer(data))
        where = np.searchsorted(cuts, offsets)
        return pieces.dictionary_encode(), np.diff(where)

    def _new_ids(self, segments: list[str]) -> list[list[int]]:
        """Ids of each segment: one-word segments by the model itself, others by the whole library."""
        out: list = [None] * len(segments)
        if self._form:
            model, words = self._tokenizer.model, self._form == "words"
            for i, w in enumerate(segments):
                if self._word(w):
                    w = w.lstrip(" ").lower() if words else w
                    out[i] = [t.id for t in model.tokenize(w if w.isascii() and w[0] != " " else w.translate(self._level))]
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, e in zip(rest, self._tokenizer.encode_batch_fast([segments[i] for i in rest], add_special_tokens=False)):
            out[i] = e.ids
        return out

    def _encode(self, pieces: pa.DictionaryArray) -> np.ndarray:
        """The number of each distinct segment; new ones are encoded."""
        words = pieces.dictionary.to_pylist()
        if len(self._known) + len(words) > self._most or len(self._ids) > 8 * self._most:
            self._forget()
        missing = [w for w in words if w not in self._known]
        ids, size = [self._ids], []
        for at in range(0, len(missing), 20_000):
            found = self._new_ids(missing[at:at + 20_000])
            size += map(len, found)
            ids.append(np.fromiter(itertools.chain.from_iterable(found), np.uint32))
        self._known.update(zip(missing, range(len(self._known), len(self._known) + len(missing))))
        self._ids = np.concatenate(ids)
        self._end = np.concatenate([self._end, self._end[-1] + np.cumsum(np.array(size, np.int64))])
        return np.fromiter(map(self._known.__getitem__, words), np.int64, len(words))

    def counts(self, column: pa.Array) -> np.ndarray:
        """Number of ids of each text (null counts as empty)."""
        out = np.zeros(len(column), dtype=np.int64)
        for a, b in split_chunks(column, self._chunk):
            pieces, per_text = self._segments(column.slice(a, b - a))
            number = self._encode(pieces)
            size = self._end[number + 1] - self._end[number]
            total = np.concatenate([[0], np.cumsum(size[np.asarray(pieces.indices)])])
            ends = np.cumsum(per_text)
            out[a:b] = total[ends] - total[ends - per_text]
        return out

    def ids(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first row, ids of a run of rows, their offsets) for run after run of the column."""
        for a, b in split_chunks(column, self._chunk):
            pieces, per_text = self._segments(column.slice(a, b - a))
            number = self._encode(pieces)[np.asarray(pieces.indices)]
            start, each = self._end[number], self._end[number + 1] - self._end[number]
            total = np.concatenate([[0], np.cumsum(each)])
            gather = np.repeat(start - total[:-1], each) + np.arange(total[-1])
            yield a, self._ids[gather], total[np.concatenate([[0], np.cumsum(per_text)])]
