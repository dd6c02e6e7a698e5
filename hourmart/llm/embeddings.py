"""Embedding near-duplicates by spherical k-means cells and blocked cosines (operator 10).

Equal vectors of one label become one node. Spherical k-means, fitted on at
most ``sample`` nodes, gives every node a home cell. For unit vectors with
cosine >= t, |x - y| <= sqrt(2 - 2t); so if y's home is n and x's is c, the
plane between the two centers is no farther from y than that. y is therefore
also shown, as a guest, in every cell c < n whose plane is that near, and each
linked pair meets in the smaller of its two homes: no pair is lost at cell
borders. Inside a cell, nodes are cut into blocks by hash, and pairs of blocks
are compared by one matrix product each.

A pair of blocks returns one row per linked node: how many vectors it is
linked to, and one node of its local component. That is enough for link
counts and classes; pairs are never emitted.

* null label, null or zero vectors, null or non-finite components: no links, a
  class of its own. Vectors of different length are never compared.
* null vec_id: component null, kept. Repeated rows are equal vectors: linked.
* ties: lowest cell. Empty table: no rows. Other columns are not read.
* a large group of near copies that are all different costs its number of
  pairs in arithmetic (block products), in bounded memory per task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourmart.llm.common import store
from hourmart.llm.components import connected_components, local_classes

SAMPLE = 20_000
CELL = 1000
MOST_CELLS = 1024
BLOCK = 1024


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 11) -> np.ndarray:
    """Unit centers (k or fewer) of unit vectors."""
    rng = np.random.default_rng(seed)
    centers = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        home = (x @ centers.T).argmax(axis=1)
        total = np.zeros_like(centers)
        np.add.at(total, home, x)
        size = np.linalg.norm(total, axis=1)
        centers = np.where(size[:, None] > 1e-12, total / np.maximum(size, 1e-12)[:, None], centers)
    return np.unique(centers, axis=0)


def _cells(centers: np.ndarray, reach: float):
    gap = np.linalg.norm(centers[:, None, :] - centers[None, :, :], axis=2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vectors = b.column("unit").to_pylist()
            out_row, out_cell, out_home = [], [], []
            fit = [i for i, v in enumerate(vectors) if len(v) == centers.shape[1]]
            for at in range(0, len(fit), 4096):
                part = fit[at:at + 4096]
                near = np.array([vectors[i] for i in part]) @ centers.T
                home = near.argmax(axis=1)
                for r, i in enumerate(part):
                    h = home[r]
                    guest = np.flatnonzero(near[r, h] - near[r, :h] <= reach * gap[h, :h] + 1e-9)
                    cells = [int(h), *guest.tolist()]
                    out_row += [i] * len(cells)
                    out_cell += cells
                    out_home += [int(h)] * len(cells)
            odd = sorted(set(range(len(vectors))) - set(fit))  # of another length: all in cell 0 of their length
            out_row, out_cell, out_home = out_row + odd, out_cell + [0] * len(odd), out_home + [0] * len(odd)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c).take(pa.array(out_row, pa.int64())) for c in ("node", "label", "copies", "unit")),
                 pa.array(out_cell, pa.int32()), pa.array(out_home, pa.int32())],
                ["node", "label", "copies", "unit", "cell", "home"])
    return run


def _compare(threshold: float):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["node"]).reset_index(drop=True)
        cell, i, j = key[-3], key[-2], key[-1]
        x = np.stack(pdf["unit"].to_numpy())
        home, block, copies = pdf["home"].to_numpy(), pdf["block"].to_numpy(), pdf["copies"].to_numpy()
        near = x @ x.T >= threshold
        near &= (home[:, None] == cell) | (home[None, :] == cell)
        if i != j:
            near &= block[:, None] != block[None, :]
        np.fill_diagonal(near, False)
        linked = np.flatnonzero(near.any(axis=1))
        if not len(linked):
            return pd.DataFrame({"node": [], "links": [], "other": []}).astype("int64")
        near = near[np.ix_(linked, linked)]
        node = pdf["node"].to_numpy()[linked]
        return pd.DataFrame({"node": node, "links": near @ copies[linked], "other": node[local_classes(near)]})
    return run


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label",
                 threshold: float = 0.98, sample: int = SAMPLE, cell: int = CELL, most_cells: int = MOST_CELLS,
                 block: int = BLOCK) -> DataFrame:
    """id, n_links (other vectors of cosine >= ``threshold``), component_id and kept of every row."""
    spark = vectors.sparkSession
    raw = F.col(vector).cast("array<double>")
    length = F.aggregate(raw, F.lit(0.0), lambda s, v: s + v * v, lambda s: F.sqrt(s))
    sound = (F.col(label).isNotNull() & F.col(vector).isNotNull()
             & F.coalesce(F.forall(raw, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(math.inf))), F.lit(False)))
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label).alias("label"), raw.alias("v"), sound.alias("sound"),
                          F.when(sound, length).alias("norm"))
    sound = F.col("sound") & (F.col("norm") > 0)
    rows = rows.select("id", "label", F.when(sound, F.transform("v", lambda e: e / F.col("norm"))).alias("unit")) \
        .withColumn("node", F.when(F.col("unit").isNotNull(), F.xxhash64("label", "unit")))
    rows = store(rows, "unit-vectors")
    nodes = store(rows.where(F.col("node").isNotNull()).groupBy("node").agg(
        F.first("label").alias("label"), F.first("unit").alias("unit"), F.count("*").alias("copies"),
        F.min("id").alias("id")), "vector-nodes")

    shape = nodes.groupBy(F.size("unit").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").first()
    if shape is None:
        return rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"),
                           F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    labels = nodes.agg(F.approx_count_distinct("label")).first()[0]
    k = max(1, min(most_cells, round(shape["n"] / max(1, labels) / cell), shape["n"] // 8))
    # the node is a hash, so its smallest values are a sample
    picked = nodes.where(F.size("unit") == shape["dim"]).orderBy("node").select("unit").limit(sample).collect()
    centers = spherical_kmeans(np.array([r["unit"] for r in picked]), k)
    reach = math.sqrt(max(0.0, 2 - 2 * threshold))
    kind = vectors.schema[label].dataType.simpleString()
    shown = store(nodes.select("node", "label", "copies", "unit").mapInArrow(
        _cells(centers, reach), f"node long, label {kind}, copies long, unit array<double>, cell int, home int")
        .withColumn("dim", F.size("unit")), "cells")
    group = ["label", "dim", "cell"]
    blocks = shown.groupBy(*group).agg(F.expr(f"cast(ceil(count(*) / {float(block)}) as int)").alias("blocks"))
    shown = shown.join(blocks, group).withColumn("block", F.pmod("node", F.col("blocks")).cast("int"))
    # every pair of blocks of a cell is one group; a block of its own is compared in (i, i)
    pairs = shown.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - F.lit(1)))) \
        .withColumn("lo", F.least("block", "with")).withColumn("hi", F.greatest("block", "with"))
    found = store(pairs.groupBy(*group, "lo", "hi").applyInPandas(
        _compare(threshold), "node long, links long, other long"), "vector-links")
    classes = connected_components(found.select(F.col("node").alias("a"), F.col("other").alias("b")))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    per = nodes.select("node", "id", "copies").join(counts, "node", "left").join(classes, "node", "left") \
        .withColumn("component", F.coalesce("component", "node"))
    first = per.groupBy("component").agg(F.min("id").alias("component_id"))
    per = per.join(first, "component").select(
        "node", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - F.lit(1)).alias("n_links"))
    out = rows.where(F.col("node").isNotNull()).join(per, "node").select("id", "n_links", "component_id") \
        .union(rows.where(F.col("node").isNull()).select("id", F.lit(0).cast("long"), F.col("id")))
    component = F.when(F.col("id").isNotNull(), F.col("component_id"))
    return out.select(F.col("id").alias(id_col), "n_links", component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))

