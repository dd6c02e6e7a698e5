"""Aggregate-expression helpers (statistics and profiling)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourmart.functions.expr import _c, half_away


def _present(c: Column) -> Column:
    """Not NULL and not NaN (the pairwise-complete rule of pandas)."""
    return c.isNotNull() & ~F.isnan(c)


def safe_corr(x: Column | str, y: Column | str) -> Column:
    """Pearson r over pairs where both values are present.

    ``F.corr`` raises a division error in ANSI mode on a constant column;
    this form gives NULL for a constant column, a single pair or no pair and
    equals ``corr`` otherwise. It is an ordinary aggregate: partial sums are
    combined map-side, so a global correlation shuffles one row per task.
    """
    xc, yc = _c(x).cast("double"), _c(y).cast("double")
    both = _present(xc) & _present(yc)
    xx = F.when(both, xc)
    yy = F.when(both, yc)
    return F.covar_pop(xx, yy) / F.nullif(F.stddev_pop(xx) * F.stddev_pop(yy), F.lit(0.0))


def _absent(df: DataFrame, column: str) -> Column:
    """Missing: NULL, or NaN in a floating-point column (as pandas counts it)."""
    c = F.col(f"`{column}`")
    return c.isNull() | F.isnan(c) if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)) else c.isNull()


def null_counts(df: DataFrame, columns: list[str] | None = None,
                name_col: str = "column_name", value_col: str = "null_count") -> DataFrame:
    """Missing values per column in one scan, as (column_name, null_count) rows."""
    cols = columns or df.columns
    wide = df.select([F.count_if(_absent(df, c)).cast("long").alias(c) for c in cols])
    return wide.unpivot([], [F.col(f"`{c}`") for c in cols], name_col, value_col)


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of numeric columns (pandas ``select_dtypes('number')``)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def column_means(df: DataFrame, columns: list[str] | None = None, digits: int = 1,
                 name_col: str = "column_name", value_col: str = "mean_value") -> DataFrame:
    """Mean of each numeric column as (column_name, mean_value) rows, largest first."""
    cols = columns or numeric_columns(df)
    wide = df.select([F.avg(F.col(f"`{c}`")).alias(c) for c in cols])
    long = wide.unpivot([], [F.col(f"`{c}`") for c in cols], name_col, value_col)
    return (long.withColumn(value_col, half_away(value_col, digits))
            .orderBy(F.col(value_col).desc_nulls_last(), F.col(name_col)))


def _chunked(bounds: Column, step: int) -> Column:
    """Sorted ``bounds`` in chunks of ``step``, and each chunk's last."""
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(bounds) - F.lit(1)) / F.lit(step)).cast("int")),
                         lambda i: F.slice(bounds, i * F.lit(step) + F.lit(1), F.lit(step)))
    return F.struct(chunks.alias("chunks"), F.transform(chunks, F.array_max).alias("lasts"))


def _cell(value: Column, bounds: Column, step: int) -> Column:
    """Number of bounds (as :func:`_chunked` has them) below ``value``: whole chunks, then those of the next."""
    whole = F.size(F.filter(bounds["lasts"], lambda b: b < value))
    rest = F.filter(F.get(bounds["chunks"], whole), lambda b: b < value)
    return whole * F.lit(step) + F.coalesce(F.array_size(rest), F.lit(0))


def rank_cells(counts: DataFrame, probs: list[float], cells: int, rounds: int) -> DataFrame:
    """The rows (v, c) of distinct values that may hold a wanted rank, with ``off``, the rank (from 0) at which
    their cell starts, and ``_n``, the number of all rows. Wanted are the ranks beside (n - 1) * p."""
    step = max(1, int(cells ** 0.5))
    left = counts.withColumn("off", F.lit(0).cast("long"))
    for k in range(rounds):
        # probes: a uniform sample of the values left, so cells are even however close or far apart the values are
        place = F.pmod(F.xxhash64("v", F.lit(k)), F.lit(cells))
        probes = left.groupBy(place.alias("_place")).agg(F.min_by("v", F.xxhash64(F.lit(k), "v")).alias("p"))
        bounds = probes.agg(F.sort_array(F.collect_list("p")).alias("b")).select(_chunked(F.col("b"), step)).scalar()
        celled = left.withColumn("_b", bounds).withColumn("cell", _cell(F.col("v"), F.col("_b"), step)).drop("_b")
        totals = celled.groupBy("off", "cell").agg(F.sum("c").alias("t"), *([F.max("_n").alias("_n")] if k else []))
        if not k:  # the first round's cells hold all rows; they are at most cells + 1
            totals = totals.withColumn("_n", F.sum("t").over(Window.partitionBy("off")))
        below = Window.partitionBy("off").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
        totals = totals.withColumn("start", F.col("off") + F.coalesce(F.sum("t").over(below), F.lit(0)))
        wanted = F.lit(False)
        for rank in (f(position(p)) for p in probs for f in (F.floor, F.ceil)):
            wanted = wanted | ((F.col("start") <= rank) & (rank < F.col("start") + F.col("t")))
        kept = totals.where(wanted).agg(F.collect_list(F.struct("off", "cell", "start", "_n"))).scalar()
        mine = F.filter("_kept", lambda s: (s["off"] == F.col("off")) & (s["cell"] == F.col("cell")))
        left = (celled.withColumn("_kept", kept).withColumn("_mine", F.get(mine, F.lit(0)))
                .where(F.col("_mine").isNotNull())
                .select("v", "c", F.col("_mine._n").alias("_n"), F.col("_mine.start").alias("off")))
    return left


def position(p: float) -> Column:
    return (F.col("_n") - F.lit(1)).cast("double") * F.lit(float(p))


def exact_quantiles(df: DataFrame, column: str, probs: list[float], buckets: int = 1024, rounds: int = 2) -> DataFrame:
    """Exact quantiles (linear interpolation between order statistics, the
    ``quantile_cont`` / pandas rule) computed without one task seeing all values.

    1. count rows per distinct value (partial aggregation: a hot value is one
       row per task, not a skewed group);
    2. rank selection: a sample of ``buckets`` values cuts the distinct values
       into cells, the rows per cell tell which cells hold a wanted rank (two
       per probability at most), and only their values go on;
    3. the same again within these cells, ``rounds`` times in all, so that a
       cell holds about (distinct values) / buckets ** rounds values;
    4. a running sum per cell gives every value left its rank span, and one
       conditional aggregate picks the values at the two ranks around each
       target position and interpolates.

    What is not distributed has at most ``buckets`` + 1 rows per wanted cell.
    Output: one row, one ``double`` column per probability (``q0``, ``q1``...),
    equal bit for bit to Spark's single-task exact ``percentile``.
    """
    v = df.select(F.col(f"`{column}`").cast("double").alias("v")).where(_present(F.col("v")))
    counts = v.groupBy("v").agg(F.count(F.lit(1)).alias("c"))
    left = rank_cells(counts, probs, buckets, rounds)
    ranked = (left.withColumn("end", F.col("off") + F.sum("c").over(
        Window.partitionBy("off").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("start", F.col("end") - F.col("c")))

    def value_at(rank: Column) -> Column:
        return F.max(F.when((F.col("start") <= rank) & (rank < F.col("end")), F.col("v")))

    # interpolation written as Spark's own exact ``percentile`` writes it:
    # (ceil - pos) * lower + (pos - floor) * upper, or lower when pos is whole
    aggs, outs = [], []
    for i, pos in enumerate(map(position, probs)):
        aggs += [value_at(F.floor(pos)).alias(f"_lo{i}"), value_at(F.ceil(pos)).alias(f"_hi{i}"),
                 F.first(pos).alias(f"_p{i}")]
        lo_v, hi_v, ps = F.col(f"_lo{i}"), F.col(f"_hi{i}"), F.col(f"_p{i}")
        f, c = F.floor(ps).cast("double"), F.ceil(ps).cast("double")
        outs.append(F.when(c == f, lo_v).otherwise((c - ps) * lo_v + (ps - f) * hi_v).alias(f"q{i}"))
    return ranked.agg(*aggs).select(*outs)


def describe_aggs(col: Column | str) -> list[Column]:
    """count, mean, sample std, min, max of one column (one partial aggregate)."""
    c = _c(col).cast("double")
    c = F.when(_present(c), c)
    return [
        F.count(c).alias("count"),
        F.avg(c).alias("mean"),
        F.stddev_samp(c).alias("std"),
        F.min(c).alias("min"),
        F.max(c).alias("max"),
    ]


def describe(df: DataFrame, column: str, digits: int = 2, exact: bool = True, accuracy: int = 100000) -> DataFrame:
    """One-row summary of ``column`` with the columns of pandas ``describe``.

    Quartiles are exact (:func:`exact_quantiles`) or, with ``exact=False``,
    from the fixed-memory ``percentile_approx`` sketch.
    """
    probs = [0.25, 0.5, 0.75]
    col = F.col(f"`{column}`")
    if exact:
        qs = exact_quantiles(df, column, probs)
        packed = qs.select(F.array(*[f"q{i}" for i in range(len(probs))])).scalar()
    else:
        packed = df.agg(F.percentile_approx(col.cast("double"), F.array(*[F.lit(p) for p in probs]),
                                            accuracy).cast("array<double>")).scalar()
    agg = df.agg(*describe_aggs(col)).withColumn("_q", packed)  # the subquery runs once
    q = [F.col("_q")[i] for i in range(len(probs))]
    return agg.select(
        F.lit(column).alias("column_name"),
        F.col("count").cast("long").alias("count"),
        half_away("mean", digits).alias("mean"),
        half_away("std", digits).alias("std"),
        half_away("min", digits).alias("min"),
        half_away(q[0], digits).alias("p25"),
        half_away(q[1], digits).alias("p50"),
        half_away(q[2], digits).alias("p75"),
        half_away("max", digits).alias("max"),
    )
