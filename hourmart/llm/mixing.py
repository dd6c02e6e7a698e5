"""Mixing sources to target weights by subset-sum budget fitting (operator 11).

Every source has a budget of words: its weight's share of all words, at most
``most`` times what it holds; what is cut off is shared again by weight among
the others. A budget is spent on whole documents:

1. as many whole passes over the source as fit (``passes``);
2. of the remaining budget, documents are counted by exact length; each length
   gives its proportional part, rounded down, so the mix keeps the source's
   lengths; single documents, longest first, then fill up to a small rest;
3. bounded-knapsack dynamic programming over the documents left by length
   fits that rest: a bit set of reachable sums, grown by each length's
   documents in powers of two, until the rest itself is reached;
4. which documents of a length are taken is decided by a seeded hash of id
   and text. The threshold hash is found by counting hash cells first, so no
   task sorts more than about ``CELL`` rows of a length that a third of all
   documents may have.

The plan of a source is made from its (length, count) rows: n words in all
have at most sqrt(2 n) different lengths, the bound of such a group.
A document is taken ``passes`` or ``passes`` + 1 times, never more than ``most``.

* null, empty and blank texts: size 0, never taken. Null sources are one source, ordered last.
* rows equal in id and text are interchangeable: as many are taken as the plan says.
* empty table: no rows. A source without words has target 0.
* columns of the input that clash with the output's are replaced.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hourmart.llm.common import document_key, sized_broadcast, store
from hourmart.operators.numbering import numbered

WEIGHTS = (5, 2, 1)
#: Rows of a (source, length) group that one task puts in order, about.
CELL = 10_000
#: The rest left to the dynamic programming, in longest documents.
REST = 4
OUTPUT = ("size", "source_size", "target", "passes", "taken")


def n_words(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", -1), "")).cast("long")


def reach(length: np.ndarray, count: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take so that their words come as near to ``budget`` as can be.

    The nearest sum is taken, the lower one of two; sums beyond budget + the longest length are not tried.
    """
    take = np.zeros(len(length), np.int64)
    if budget <= 0 or not len(length):
        return take
    width = budget + int(length.max()) + 1
    mask, sums, items = (1 << width) - 1, 1, []
    added = []  # what each item made reachable first
    for i in np.lexsort((length, -count)):
        left, part = min(int(count[i]), width // int(length[i])), 1
        while left and not (sums >> budget) & 1:
            n = min(part, left)
            new = (sums << (n * int(length[i]))) & mask & ~sums
            if new:
                sums |= new
                items.append((int(i), n))
                added.append(new)
            left -= n
            part *= 2
        if (sums >> budget) & 1:
            break
    low = sums & ((1 << (budget + 1)) - 1)
    at = low.bit_length() - 1
    above = sums >> (budget + 1)
    if above:
        gap = (above & -above).bit_length()
        if gap < budget - at:
            at = budget + gap
    for (i, n), new in zip(reversed(items), reversed(added)):
        if (new >> at) & 1:  # an item's own sums were made from earlier items only
            take[i] += n
            at -= n * int(length[i])
    return take


def fit(length: np.ndarray, count: np.ndarray, budget: int) -> np.ndarray:
    """Documents to take of each length for a budget below all words together."""
    order = np.argsort(-length, kind="stable")
    size, have = length[order].astype(object), count[order].astype(object)  # exact: products pass 64 bits
    total = int((size * have).sum())
    if budget >= total:
        return count.copy()
    take = have * budget // total
    rest = budget - int((size * take).sum())
    small = REST * int(size[0])
    for i in range(len(size)):
        if rest <= small:
            break
        if have[i] > take[i] and size[i] <= rest:
            take[i] += 1
            rest -= size[i]
    take = take.astype(np.int64)
    take += reach(length[order], have.astype(np.int64) - take, int(rest))
    out = np.zeros(len(length), np.int64)
    out[order] = take
    return out


def _plan(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("size").reset_index(drop=True)
    sized = pdf[pdf["size"] > 0]
    total, target, most = int(pdf["source_size"].iloc[0]), float(pdf["target"].iloc[0]), int(pdf["most"].iloc[0])
    passes = min(int(target // total), most) if total else 0
    budget = round(target) - passes * total if passes < most else 0
    extra = np.zeros(len(pdf), np.int64)
    if len(sized) and budget > 0:
        extra[sized.index] = fit(sized["size"].to_numpy(), sized["c"].to_numpy(), budget)
    return pdf.assign(passes=passes, extra=extra)[["s", "size", "c", "source_size", "target", "passes", "extra"]]


def targets(per_source: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = 3) -> DataFrame:
    """``per_source`` (source, source_size) with ``s`` (its number from 1) and its target.

    A round fixes the sources whose share is above ``most`` times their size and shares the rest anew;
    each is one aggregate over the sources, and ends when none is above.
    """
    cycle = F.array(*[F.lit(w) for w in weights])
    sources = store(numbered(per_source, ["source"], "s", nulls_last=True).withColumn(
        "w", F.element_at(cycle, (F.pmod(F.col("s") - 1, F.lit(len(weights))) + 1).cast("int")).cast("long"))
        .withColumn("cap", F.lit(most) * F.col("source_size")), "sources")
    total = int(sources.agg(F.sum("source_size")).first()[0] or 0)
    # a source is fixed when w * amount / weight > cap; (amount, weight) grows only, so the last pair decides alone
    amount, weight = total, int(sources.agg(F.sum("w")).first()[0] or 0)
    over = F.lit(False)
    while weight:
        wide = "decimal(38,0)"
        above = F.col("w").cast(wide) * F.lit(amount).cast("decimal(20,0)") > \
            F.col("cap").cast(wide) * F.lit(weight).cast("decimal(18,0)")
        over = over | above
        r = sources.agg(F.sum(F.when(over, F.col("cap")).otherwise(0)).alias("fixed"),
                        F.sum(F.when(over, F.lit(0)).otherwise(F.col("w"))).alias("w"),
                        F.count_if(above).alias("n")).first()
        if total - r["fixed"] == amount:
            break
        amount, weight = total - int(r["fixed"]), int(r["w"])
    share = F.col("w").cast("double") * F.lit(float(amount)) / F.lit(float(max(weight, 1)))
    return sources.withColumn("target", F.when(over, F.col("cap").cast("double")).otherwise(share)).drop("w", "cap")


def mix(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
        weights: tuple[int, ...] = WEIGHTS, most: int = 3, seed: int = 11, cell: int = CELL) -> DataFrame:
    """``docs`` with size, source_size, target, passes (how often the mix takes it) and taken (words it takes)."""
    docs = docs.drop(*[c for c in OUTPUT if c not in (id_col, text, source)])
    order = F.xxhash64(F.lit(seed), F.col(id_col), document_key(F.col(text)))
    rows = store(docs.select(F.col(source).alias("source"), n_words(F.col(text)).alias("size"), order.alias("h")), "mix-rows")
    lengths = store(rows.groupBy("source", "size").agg(F.count("*").alias("c")), "mix-lengths")
    sources = store(targets(lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("c")).alias("source_size")),
                            weights, most), "mix-targets")
    same = F.col("l.source").eqNullSafe(F.col("t.source"))
    known = lengths.alias("l").join(sized_broadcast(sources).alias("t"), same).select("s", "size", "c", "source_size", "target")
    plan = store(known.withColumn("most", F.lit(most)).groupBy("s").applyInPandas(
        _plan, "s long, size long, c long, source_size long, target double, passes long, extra long"), "mix-plan")
    plan = store(plan.join(sized_broadcast(sources.select("s", "source")), "s"), "mix-named-plan")

    # the hash of the last document taken of each length that is taken in part
    parts = plan.where((F.col("extra") > 0) & (F.col("extra") < F.col("c"))) \
        .select("s", "source", "size", "extra", F.ceil(F.col("c") / F.lit(float(cell))).alias("cells"))
    of = F.least(F.floor((F.col("h").cast("double") / F.lit(2.0 ** 64) + F.lit(0.5)) * F.col("cells")),
                 F.col("cells") - 1)
    r, p = rows.alias("r"), sized_broadcast(parts).alias("p")
    dealt = store(r.join(p, F.col("r.source").eqNullSafe(F.col("p.source")) & (F.col("r.size") == F.col("p.size")))
                  .select("s", "p.size", "extra", of.alias("cell"), "h"), "mix-cells")
    w = Window.partitionBy("s", "size").orderBy("cell")
    crossing = (dealt.groupBy("s", "size", "extra", "cell").agg(F.count("*").alias("n"))
                .withColumn("below", F.sum("n").over(w) - F.col("n"))
                .where((F.col("below") < F.col("extra")) & (F.col("below") + F.col("n") >= F.col("extra")))
                .select("s", "size", "cell", (F.col("extra") - F.col("below")).alias("k")))
    nth = Window.partitionBy("s", "size").orderBy("h")
    last = store(dealt.drop("extra").join(sized_broadcast(store(crossing, "mix-crossing")), ["s", "size", "cell"])
                 .withColumn("i", F.row_number().over(nth)).where(F.col("i") <= F.col("k"))
                 .groupBy("s", "size").agg(F.max("h").alias("last")), "mix-last")
    # rows that share the last hash (equal rows) are told apart only where there are such
    ties = (dealt.join(sized_broadcast(last), ["s", "size"]).where(F.col("h") <= F.col("last"))
            .groupBy("s", "size").agg(F.count("*").alias("n"), F.max("extra").alias("extra"))
            .where(F.col("n") > F.col("extra")).select("s", "size", (F.col("n") - F.col("extra")).alias("spare")))
    chosen = store(plan.join(last, ["s", "size"], "left").join(ties, ["s", "size"], "left"), "mix-chosen")
    has_ties = bool(chosen.where("spare is not null").limit(1).count())

    wide = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(source).alias("source"),
                       n_words(F.col(text)).alias("size"), order.alias("h")).alias("d")
    choice = sized_broadcast(chosen.select("s", "source", "size", "source_size", "target", "passes", "extra", "c", "last",
                                           "spare")).alias("c")
    out = wide.join(choice, F.col("d.source").eqNullSafe(F.col("c.source")) & (F.col("d.size") == F.col("c.size"))) \
        .select("row", "d.size", "h", "s", "source_size", "target", "passes", "extra", F.col("c.c").alias("have"), "last", "spare")
    more = F.when(F.col("extra") == 0, False).when(F.col("last").isNull(), F.col("extra") >= F.col("have")) \
        .otherwise(F.col("h") <= F.col("last"))
    if has_ties:
        tied = F.col("spare").isNotNull() & (F.col("h") == F.col("last"))
        among = Window.partitionBy("s", "size").orderBy("h")
        out = out.where(~F.coalesce(tied, F.lit(False))).withColumn("more", more).unionByName(
            out.where(tied).withColumn("more", F.row_number().over(among) > F.col("spare")))
    else:
        out = out.withColumn("more", more)
    passes = F.col("passes") + F.col("more").cast("long")
    passes = F.when(F.col("size") > 0, passes).otherwise(F.lit(0)).cast("long")
    kept = [c for c in docs.columns if c not in OUTPUT]
    return out.select(*[F.col("row")[c].alias(c) for c in kept], "size", "source_size", "target",
                      passes.alias("passes"), (passes * F.col("size")).alias("taken"))
