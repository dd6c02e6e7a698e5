"""Vector bin packing of tokenized documents (operator 9).

An example has three sizes: tokens, segments (one per piece) and loss-bearing
tokens; a sequence limits all three. Documents longer than a sequence are cut
into full pieces and a rest. Rests are placed by the dot-product heuristic: the
open sequence takes, of the pieces that fit, the one with the largest weighted
dot product of its sizes with the room left, the weights being each
dimension's mean demand. When none fits and at least ``min_cut`` tokens are
free, the piece with the largest dot product is cut to fill them.

Each task packs the documents of its own partition, ``group`` pieces at a
time, so nothing is shuffled and no key can be hot; only the last sequence of
a group stays part empty. Ids of lost tasks come out the same again.

* null or empty text: the end token alone. Empty table: no rows.
* loss-bearing: every token but a document's first ``prompt`` ones (a column;
  null counts as 0) and its very first, which nothing precedes.
* repeated rows are packed each for itself; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourmart.llm.segments import SegmentEncoder

TOKENS, SEGMENTS = 2048, 64
GROUP = 4096
MIN_CUT = 32


def _loss(start: np.ndarray, length: np.ndarray, prompt: np.ndarray) -> np.ndarray:
    """Loss-bearing tokens of pieces [start, start + length) of documents with ``prompt`` silent tokens."""
    return np.maximum(0, start + length - np.maximum(start, np.maximum(prompt, 1)))


def place(length: np.ndarray, start: np.ndarray, prompt: np.ndarray, limits: tuple[int, int, int],
          min_cut: int = MIN_CUT) -> list[tuple[int, int, int, int, int]]:
    """Pack pieces: (piece, start, length, sequence, offset) rows; a cut piece has several."""
    cap = np.array(limits, float)
    start, length = start.astype(np.int64).copy(), length.astype(np.int64).copy()
    size = np.stack([length, np.ones_like(length), _loss(start, length, prompt)], axis=1).astype(float)
    weight = size.mean(axis=0) / cap if len(size) else cap
    value = size * (weight / cap)
    alive = np.ones(len(length), bool)
    index = np.arange(len(length))
    out, sequence, room, offset, left = [], 0, cap.copy(), 0, len(length)
    while left:
        if len(index) > 64 and left < len(index) // 2:  # drop placed pieces from the scan now and then
            index = index[alive[index]]
        s = size[index]
        fits = alive[index] & (s[:, 0] <= room[0]) & (s[:, 1] <= room[1]) & (s[:, 2] <= room[2])
        score = value[index] @ (room / cap)
        if fits.any():
            i = int(index[np.argmax(np.where(fits, score, -1.0))])
            take = int(length[i])
        else:
            free = int(min(room[0], room[2])) if room[1] >= 1 else 0
            if offset and free < min_cut:
                sequence, room, offset = sequence + 1, cap.copy(), 0
                continue
            i = int(index[np.argmax(np.where(alive[index], score, -1.0))])
            take = min(free, int(length[i]))  # room for that many tokens even if all bear loss
        loss = float(_loss(start[i:i + 1], np.array([take]), prompt[i:i + 1])[0])
        out.append((i, int(start[i]), take, sequence, offset))
        room -= (take, 1, loss)
        offset += take
        if take == length[i]:
            alive[i] = False
            left -= 1
        else:
            start[i] += take
            length[i] -= take
            size[i] = (length[i], 1, _loss(start[i:i + 1], length[i:i + 1], prompt[i:i + 1])[0])
            value[i] = size[i] * (weight / cap)
        if room[0] < 1 or room[1] < 1:
            sequence, room, offset = sequence + 1, cap.copy(), 0
    return out


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text: str = "text",
         prompt: str | None = None, end_id: int = 1, limits: tuple[int, int, int] = (TOKENS, SEGMENTS, TOKENS),
         group: int = GROUP, min_cut: int = MIN_CUT, cache_segments: int = 0, chunk_bytes: int = 0) -> DataFrame:
    """A row per piece: id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, loss_tokens,
    sequence_id, offset. Only whole pieces of ``limits[0]`` tokens and rests of documents are cut further.

    ``cache_segments``, ``chunk_bytes``: the encoder's memory where that is short (0: its own sizes); results are equal.
    """
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, id_type), T.StructField("start", T.LongType()),
                           T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType()),
                           T.StructField("doc_tokens", T.LongType()), T.StructField("loss_tokens", T.LongType()),
                           T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"),
                       (F.coalesce(F.col(prompt), F.lit(0)) if prompt else F.lit(0)).cast("long").alias("prompt"))
    widest = limits[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = SegmentEncoder(tokenizer_path, cache_segments, chunk_bytes)
        first = TaskContext.get().partitionId() << 40
        pieces: list[tuple] = []  # (id, start, ids, doc_tokens, prompt)
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal first, pieces, held
            start = np.array([p[1] for p in pieces], np.int64)
            size = np.array([len(p[2]) for p in pieces], np.int64)
            silent = np.array([p[4] for p in pieces], np.int64)
            placed = place(size, start, silent, limits, min_cut)
            got = [(pieces[i], at, n, seq, off) for i, at, n, seq, off in placed]
            yield pa.RecordBatch.from_arrays([
                pa.array([p[0] for p, *_ in got]).cast(id_arrow),
                pa.array([at for _, at, *_ in got], pa.int64()), pa.array([n for _, _, n, *_ in got], pa.int64()),
                pa.array([p[2][at - p[1]:at - p[1] + n].tobytes() for p, at, n, *_ in got], pa.binary()),
                pa.array([p[3] for p, *_ in got], pa.int64()),
                pa.array(_loss(np.array([at for _, at, *_ in got], np.int64), np.array([n for _, _, n, *_ in got], np.int64),
                               np.array([p[4] for p, *_ in got], np.int64)), pa.int64()),
                pa.array([first + seq for *_, seq, _ in got], pa.int64()),
                pa.array([off for *_, off in got], pa.int64())], [f.name for f in schema])
            first += max((seq for *_, seq, _ in got), default=-1) + 1
            pieces, held = [], 0

        id_arrow = None
        for b in batches:
            id_arrow = b.column("id").type
            names, silent = b.column("id").to_pylist(), b.column("prompt").to_pylist()
            for at, flat, ends in encoder.ids(b.column("text")):
                for k in range(len(ends) - 1):
                    ids = np.append(flat[ends[k]:ends[k + 1]], np.uint32(end_id)).astype("<u4")
                    for s in range(0, len(ids), widest):
                        pieces.append((names[at + k], s, ids[s:s + widest], len(ids), silent[at + k]))
                    held += len(ids)
                    if len(pieces) >= group or held >= 4 * group * 256:
                        yield from flush()
        if pieces:
            yield from flush()

    return rows.mapInArrow(run, schema)
