"""Data-quality and profiling views (AGG-16, STA-06..12)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourmart import schemas as S
from hourmart.functions.expr import literal_table
from hourmart.functions.stats import column_means, describe, null_counts
from hourmart.plans.common import DEFAULT_CITY
from hourmart.sources.catalog import Tables


def row_counts(t: Tables, tables: list[str] | None = None) -> DataFrame:
    """AGG-16: rows per built table, one (table_name, row_count) row each.

    One job: every table is a branch of a single union, counted with a
    partial count per task; a stored warehouse answers from its files' footers.
    """
    names = tables or S.ALL_TABLES
    parts = [t.row_count(n).select(F.lit(n).alias("table_name"), "row_count") for n in names]
    return reduce(DataFrame.unionByName, parts)


def describe_prices(t: Tables, exact: bool = True) -> DataFrame:
    """STA-06: count, mean, std, min, quartiles, max of the hourly price."""
    return describe(t.table("raw_prices"), "price_eur_mwh", digits=2, exact=exact)


def describe_city_radiation(t: Tables, city: str = DEFAULT_CITY, exact: bool = True) -> DataFrame:
    """STA-06: the same summary for one city's radiation."""
    w = t.table("raw_weather").where(F.col("city") == F.lit(city))
    return describe(w, "shortwave_radiation_wm2", digits=2, exact=exact)


def generation_null_counts(t: Tables) -> DataFrame:
    """STA-07: missing values per column of the raw generation table."""
    return null_counts(t.table("raw_generation"))


def prices_missing_total(t: Tables) -> DataFrame:
    """STA-08: missing values over the whole raw price table."""
    nc = null_counts(t.table("raw_prices"))
    return nc.agg(F.coalesce(F.sum("null_count"), F.lit(0)).cast("long").alias("missing_values"))


def city_time_range(t: Tables, city: str = DEFAULT_CITY) -> DataFrame:
    """STA-09: first and last timestamp of one city's weather."""
    w = t.table("raw_weather").where(F.col("city") == F.lit(city))
    return w.agg(F.min("timestamp").alias("first_timestamp"), F.max("timestamp").alias("last_timestamp"),
                 F.count(F.lit(1)).cast("long").alias("n_rows"))


def duplicate_key_report(t: Tables) -> DataFrame:
    """STA-10: rows vs distinct keys per table (fan-out diagnosis).

    Each table is grouped by its key (partial counts map-side), then the
    per-key counts are summarised; only one summary row per table comes out.
    A key with more than one row (a repeated autumn hour, sub-hourly data)
    shows up as ``duplicate_keys > 0`` before it multiplies a join.
    """
    specs = [
        ("dim_date", ["date_key"]),
        ("fct_prices_hourly", ["date_key"]),
        ("fct_generation_hourly", ["date_key"]),
        ("fct_weather_hourly", ["date_key", "city_key"]),
        ("dim_city", ["city"]),
    ]
    parts = []
    for name, keys in specs:
        per_key = t.table(name).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        parts.append(per_key.agg(
            F.lit(name).alias("table_name"),
            F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("n_rows"),
            F.count(F.lit(1)).cast("long").alias("n_keys"),
            F.count_if(F.col("_n") > F.lit(1)).cast("long").alias("duplicate_keys"),
            F.coalesce(F.max("_n"), F.lit(0)).cast("long").alias("max_rows_per_key"),
        ))
    return reduce(DataFrame.unionByName, parts)


def generation_source_means(t: Tables) -> DataFrame:
    """STA-11: mean output per generation source, largest first (1 dp)."""
    g = t.table("raw_generation")
    return column_means(g, [src for src, _ in S.GENERATION_SOURCES], digits=1)


def table_shape(t: Tables, name: str = "raw_weather") -> DataFrame:
    """STA-12: row count, and name / type / position of every column."""
    df = t.table(name)
    n_rows = df.agg(F.count(F.lit(1)).cast("long")).scalar()
    cols = literal_table(t.spark, [(i + 1, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)],
                         ["ordinal", "column_name", "data_type"])
    return cols.select(F.lit(name).alias("table_name"), "ordinal", "column_name", "data_type",
                       n_rows.alias("n_rows"))
