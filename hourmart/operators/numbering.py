"""Dense numbering of a distinct list in key order, without one task that sees the whole list.

``row_number`` over a window without partition sorts everything in one task.
Here the list is cut into ranges, each numbered by itself, and every range
starts after the rows of those before it:

1. a sample of ``ranges`` keys: keys are dealt to that many places by hash,
   the key of the least second hash stands for each place (a partial
   aggregate; a uniform sample whatever the keys look like);
2. a key's range is the number of sampled keys below it;
3. rows per range, at most ``ranges`` + 1 numbers, give each range's start;
4. number = start + ``row_number`` within the range.

Steps 1 and 3 are scalar subqueries, so nothing runs before the query does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Sampled keys; a range holds about (list / RANGES) rows.
RANGES = 256


def numbered(df: DataFrame, keys: list[str], name: str, ranges: int = RANGES, nulls_last: bool = False) -> DataFrame:
    """``df`` with the long column ``name``: 1 to n in order of ``keys`` (which must be distinct in ``df``).

    NULL keys come first, as in an ascending sort, or last.
    """
    def with_flags(c: str) -> list[Column]:
        # a struct compares field by field, NULL first: the flag moves NULLs to the end
        return [F.col(c).isNull().alias(f"{c}_last"), F.col(c)] if nulls_last else [F.col(c)]

    key = F.struct(*[k for c in keys for k in with_flags(c)])
    keyed = df.withColumn("_key", key)
    place = F.pmod(F.xxhash64(*keys), F.lit(ranges))
    sample = keyed.groupBy(place.alias("_place")).agg(F.min_by("_key", F.xxhash64(F.lit(1), *keys)).alias("_at"))
    bounds = sample.agg(F.array_sort(F.collect_list("_at"))).scalar()
    ranged = keyed.withColumn("_bounds", bounds) \
        .withColumn("_range", F.size(F.filter("_bounds", lambda b: b < F.col("_key")))).drop("_bounds")
    counts = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("c"))
    starts = counts.agg(F.collect_list(F.struct("_range", "c"))).scalar()
    before = F.aggregate(F.filter("_starts", lambda s: s["_range"] < F.col("_range")), F.lit(0).cast("long"),
                         lambda total, s: total + s["c"])
    within = F.row_number().over(Window.partitionBy("_range").orderBy("_key"))
    return ranged.withColumn("_starts", starts).withColumn(name, (before + within).cast("long")) \
        .drop("_key", "_range", "_starts")
