"""Byte-balanced shards by histogram sort (operator 5).

Rows are put in key order and cut into shards of near equal bytes. The cuts
are found without sorting: every round counts, across all partitions, the
exact bytes and rows below a set of candidate boundaries, then puts new
candidates into the cells that still matter: those that hold a wanted
splitter and are wider than the tolerance, and those too heavy for one task.
When none is left every row's shard and range are known, and the rows cross
the network once, one sorted range per group.

The key is (sort key, row position): positions spread the rows of one key, so
a key with a third of all rows is cut like any other. A position is the row's
place in its file, so every pass sees the same one however the scan is split
and whichever executors are left. The input must be read from files; any other
is stored first.

* null text: size 1 (no bytes); null sort key: before all others.
* ties and repeated rows: each row has its own slot, in scan order.
* empty table: no rows. Clashing extra columns are replaced by the outputs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hourmart.llm.common import store

_LOW = 1 << 63
#: Candidate boundaries put into a cell per round.
PROBES = 15


def _placed(df: DataFrame) -> DataFrame:
    """``df`` with ``_p``: a row's file and place in it, spread over the whole 64-bit range so that equal keys
    can be cut anywhere."""
    def positioned(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_p", F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index"), F.lit(7)))

    try:
        return positioned(df)
    except AnalysisException:  # no rows of a file: joins, generators, Python
        return positioned(store(df, "shard-input", compression="zstd"))


def _to_pairs(bounds: list[int]) -> np.ndarray:
    """128-bit boundaries as sortable (key, position) pairs."""
    out = np.empty(len(bounds), dtype=[("k", "<u8"), ("p", "<u8")])
    out["k"] = [b >> 64 for b in bounds]
    out["p"] = [b & ((1 << 64) - 1) for b in bounds]
    return out


def _cell(bounds: np.ndarray, key: np.ndarray, position: np.ndarray) -> np.ndarray:
    """Number of boundaries at or below each (key, position)."""
    k = key.astype(np.int64).view(np.uint64) ^ np.uint64(_LOW)
    p = position.astype(np.int64).view(np.uint64) ^ np.uint64(_LOW)
    lo = np.searchsorted(bounds["k"], k, side="left")
    hi = np.searchsorted(bounds["k"], k, side="right")
    out = lo.copy()
    tied = np.flatnonzero(hi > lo)  # rows whose key is itself a boundary's key: the position decides
    order = tied[np.argsort(lo[tied], kind="stable")]
    for rows in np.split(order, np.flatnonzero(np.diff(lo[order])) + 1):
        if len(rows):
            a, b = lo[rows[0]], hi[rows[0]]
            out[rows] = a + np.searchsorted(bounds["p"][a:b], p[rows], side="right")
    return out


def _histogram(keys: DataFrame, bounds: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Exact bytes and rows in each of the len(bounds) + 1 cells, counted in the partitions and summed."""
    table = keys.sparkSession.sparkContext.broadcast(_to_pairs(bounds))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(table.value) + 1
        size, rows = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for b in batches:
            cell = _cell(table.value, np.asarray(b.column("_k")), np.asarray(b.column("_p")))
            size += np.bincount(cell, np.asarray(b.column("size")), n).astype(np.int64)
            rows += np.bincount(cell, minlength=n)
        used = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(size[used]), pa.array(rows[used])],
                                         ["cell", "size", "rows"])

    found = (keys.mapInArrow(count, "cell long, size long, rows long")
             .groupBy("cell").agg(F.sum("size").alias("size"), F.sum("rows").alias("rows")).toPandas())
    size, rows = np.zeros(len(bounds) + 1, np.int64), np.zeros(len(bounds) + 1, np.int64)
    size[found["cell"]], rows[found["cell"]] = found["size"], found["rows"]
    return size, rows


def _refine(keys: DataFrame, lowest: int, highest: int, total: int, shards: int, slack: int,
            target: int) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Boundaries (the first is ``lowest``) with the bytes and rows from each to the next."""
    first = max(4 * shards, 2 * (total // target + 1))
    edges = sorted({lowest + (highest - lowest) * i // first for i in range(first)})
    while True:
        size, rows = _histogram(keys, edges)
        size, rows = size[1:], rows[1:]  # nothing lies below the first boundary
        below = np.concatenate([[0], np.cumsum(size)])
        wanted = [total * j // shards for j in range(1, shards)]
        split = set(np.flatnonzero(size > 2 * target).tolist())
        for w in wanted:
            c = int(np.searchsorted(below, w, side="right")) - 1
            if min(w - below[c], below[c + 1] - w) > slack:
                split.add(c)
        new = set()
        for c in split:
            lo, hi = edges[c], edges[c + 1] if c + 1 < len(edges) else highest + 1
            if rows[c] > 1:
                new |= {lo + (hi - lo) * i // (PROBES + 1) for i in range(1, PROBES + 1)} - {lo}
        if not new - set(edges):
            return edges, size, rows
        edges = sorted(set(edges) | new)


def histogram_shards(df: DataFrame, key: str, size: F.Column, shards: int, tolerance: float = 0.001,
                     target_bytes: int = 32 << 20) -> DataFrame:
    """``df`` with ``size``, ``shard`` (0 to shards - 1, in key order) and ``slot`` (gapless from 0 in each).

    ``tolerance``: a shard's bytes may miss its share by this part of a share,
    or by one row if that is more. ``target_bytes``: the most a task sorts
    (about; a single row may be larger). The driver holds one boundary per such range.
    """
    df = df.drop("size", "shard", "slot")
    wide = (_placed(df).withColumn("size", size.cast("long"))
            .withColumn("_k", F.coalesce(F.col(key).cast("long"), F.lit(-_LOW))))
    keys = store(wide.select("_k", "_p", "size"), "shard-keys")
    ends = keys.agg(F.min("_k").alias("lo"), F.max("_k").alias("hi"), F.sum("size").alias("bytes")).first()
    if ends["bytes"] is None:
        return wide.drop("_k", "_p").withColumn("shard", F.lit(0)).withColumn("slot", F.lit(0).cast("long"))
    total = int(ends["bytes"])
    lowest, highest = (ends["lo"] + _LOW) << 64, ((ends["hi"] + _LOW + 1) << 64) - 1
    slack = max(1, int(total / shards * tolerance / 2))
    edges, cell_size, cell_rows = _refine(keys, lowest, highest, total, shards, slack, target_bytes)

    # the boundary nearest to each wanted cut starts the next shard
    below = np.concatenate([[0], np.cumsum(cell_size)])
    cuts = [int(np.argmin(np.abs(below - total * j // shards))) for j in range(1, shards)]
    shard_of = np.searchsorted(cuts, np.arange(len(edges)), side="right")
    rows_below = np.concatenate([[0], np.cumsum(cell_rows)])
    # neighbouring cells of a shard share a range while they stay under the target
    range_of, first_slot, total_here = np.zeros(len(edges), np.int64), [0], 0
    for c in range(1, len(edges)):
        new_shard = shard_of[c] != shard_of[c - 1]
        total_here += int(cell_size[c - 1])
        if new_shard or total_here + cell_size[c] > target_bytes:
            range_of[c], total_here = range_of[c - 1] + 1, 0
            start = rows_below[np.searchsorted(shard_of, shard_of[c])]
            first_slot.append(int(rows_below[c] - start))
        else:
            range_of[c] = range_of[c - 1]
    plan = df.sparkSession.sparkContext.broadcast(
        (_to_pairs(edges), shard_of.astype(np.int32), range_of, np.array(first_slot, np.int64)))

    @F.pandas_udf("shard int, range int, start long")
    def place(k: pd.Series, p: pd.Series) -> pd.DataFrame:
        bounds, shard, ranges, start = plan.value
        c = _cell(bounds, k.to_numpy(), p.to_numpy()) - 1
        return pd.DataFrame({"shard": shard[c], "range": ranges[c].astype(np.int32), "start": start[ranges[c]]})

    placed = wide.withColumn("_at", place("_k", "_p"))
    w = Window.partitionBy("_range").orderBy("_k", "_p")
    placed = (placed.withColumn("shard", F.col("_at.shard")).withColumn("_range", F.col("_at.range"))
              .withColumn("_start", F.col("_at.start")).drop("_at"))
    return (placed.repartitionById(len(first_slot), F.col("_range"))
            .withColumn("slot", F.col("_start") + F.row_number().over(w) - F.lit(1))
            .drop("_k", "_p", "_range", "_start"))
