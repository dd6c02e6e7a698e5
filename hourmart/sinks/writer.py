"""Writers: warehouse zones as Parquet (SNK-01..06, AGG-16 by observation).

Layout ``<base>/<zone>/<table>``. Time-based tables are partitioned by a
period column (``year`` by default, ``date`` for day-sized partitions under
a daily feed) and sorted on their time key inside each file, so row-group
min/max statistics are tight and a key-range filter skips row groups.

Each zone is built from the *stored* zone below it (read back from the
written files), so lineage is cut at every zone and a lost executor only
recomputes the current zone.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from hourmart import schemas as S
from hourmart.functions.expr import date_key_year
from hourmart.sources.catalog import LayeredTables, StoredTables, Tables

PERIODS = ("year", "month", "date")


def _period_from_ts(ts: Column, period: str) -> Column:
    if period == "year":
        return F.year(ts)
    if period == "month":
        return F.year(ts) * F.lit(100) + F.month(ts)
    if period == "date":
        return F.to_date(ts)
    raise ValueError(f"period must be one of {PERIODS}")


def _period_from_key(key: Column, period: str) -> Column:
    if period == "year":
        return date_key_year(key)
    if period == "month":
        return (key / F.lit(10000)).cast("int")
    if period == "date":
        return (key / F.lit(100)).cast("int")
    raise ValueError(f"period must be one of {PERIODS}")


# table -> (how to derive the period column, sort columns); None = not partitioned
LAYOUT: dict[str, tuple[str | None, list[str]]] = {
    "raw_weather": ("timestamp", ["timestamp", "city"]),
    "raw_prices": ("timestamp", ["timestamp"]),
    "raw_generation": ("timestamp", ["timestamp"]),
    "cleaned_weather": ("timestamp", ["timestamp", "city"]),
    "cleaned_prices": ("timestamp", ["timestamp"]),
    "cleaned_generation": ("timestamp", ["timestamp"]),
    "dim_date": (None, ["date_key"]),
    "dim_city": (None, ["city_key"]),
    "fct_weather_hourly": ("date_key", ["date_key", "city_key"]),
    "fct_prices_hourly": ("date_key", ["date_key"]),
    "fct_generation_hourly": ("date_key", ["date_key"]),
}


def partition_column(table: str, period: str) -> str | None:
    src, _ = LAYOUT[table]
    if src is None:
        return None
    return {"year": "p_year", "month": "p_month", "date": "p_date"}[period]


def with_period(df: DataFrame, table: str, period: str) -> DataFrame:
    src, _ = LAYOUT[table]
    if src is None:
        return df
    col = partition_column(table, period)
    if col in df.columns:
        return df
    value = _period_from_ts(F.col(src), period) if src == "timestamp" else _period_from_key(F.col(src), period)
    return df.withColumn(col, value)


def write_table(df: DataFrame, path: str, table: str, period: str = "year",
                mode: str = "overwrite", replace: str = "all", in_order: bool = False) -> int:
    """Write one table and return its row count (counted during the write).

    Range-partitioning on the sort key spreads every period over several
    tasks (a hash on the period would put a whole year in one task); AQE
    sizes the number of ranges from the measured data. ``replace="all"``
    replaces the whole table (a full build: a period gone from the source is
    gone from the table); ``replace="periods"`` replaces only the periods
    present in ``df`` (dynamic partition overwrite).

    With ``in_order`` the rows already come from range-partitioned files (a
    zone derived row by row from the stored zone below): tasks sort their own
    rows and write, with no exchange.
    """
    if replace not in ("all", "periods"):
        raise ValueError("replace must be 'all' or 'periods'")
    src, sort_cols = LAYOUT[table]
    obs = Observation(f"rows_{table}")
    out = with_period(df, table, period)
    pcol = partition_column(table, period)
    if not in_order:
        out = out.repartitionByRange(*[F.col(c).asc_nulls_last() for c in sort_cols])
    # the period leads, as the partitioned writer needs it: one sort serves both
    out = (out.sortWithinPartitions(*([pcol] if pcol else []), *sort_cols)
           # observed above the exchange: the range sampler's job must not count
           .observe(obs, F.count(F.lit(1)).alias("rows")))
    w = out.write.mode(mode).option("partitionOverwriteMode", "dynamic" if replace == "periods" else "static")
    if pcol:
        w = w.partitionBy(pcol)
    w.parquet(path)
    rows = int(obs.get["rows"])
    if rows == 0 and pcol and replace == "all":
        # a partitioned write of no rows leaves no file to read the schema from:
        # keep one empty file that carries it
        with_period(df, table, period).limit(0).write.mode("overwrite").parquet(path)
    return rows


def _write_zone(jobs: list[tuple[str, DataFrame, str]], period: str, parallel: int, in_order: bool) -> dict[str, int]:
    """Write the tables of one zone; independent tables run as concurrent jobs.

    The tables of a zone do not depend on each other, so their jobs are
    submitted together from driver threads and share the executors instead
    of queueing one by one.
    """
    if parallel <= 1 or len(jobs) == 1:
        return {name: write_table(df, path, name, period, in_order=in_order) for name, df, path in jobs}
    with ThreadPoolExecutor(max_workers=min(parallel, len(jobs))) as pool:
        futures = {name: pool.submit(write_table, df, path, name, period, in_order=in_order) for name, df, path in jobs}
        return {name: f.result() for name, f in futures.items()}


class DuplicateKeyError(ValueError):
    pass


def assert_unique_date_keys(dim_date: DataFrame) -> None:
    """Fail when two timestamps share an hour key (sub-hourly input).

    Runs on the stored dimension (one row per hour of history): a grouped
    count stopped at the first duplicate.
    """
    dup = dim_date.groupBy("date_key").count().where(F.col("count") > F.lit(1)).limit(1).collect()
    if dup:
        raise DuplicateKeyError(f"dim_date: date_key {dup[0]['date_key']} appears {dup[0]['count']} times")


def build_warehouse(spark: SparkSession, source: Tables, base: str, period: str = "year",
                    tables: list[str] | None = None, parallel: int = 3,
                    check_keys: bool = True) -> dict[str, int]:
    """Land the raw zone from ``source``, then build cleaned and star zones
    from the stored zone below. Returns rows written per table (AGG-16).

    With ``check_keys`` the stored ``dim_date`` must have one row per hour
    key before any fact is built on it."""
    stored = StoredTables(spark, base)
    wanted = tables or S.ALL_TABLES

    # Each layer reads the stored layer below it: lineage stops at the files.
    def from_store(names: list[str]) -> LayeredTables:
        return LayeredTables(spark, {}, {n: (lambda n=n: stored.table(n)) for n in names}, measure=True)

    def zone(resolver: Tables, names: list[str], in_order: bool = False) -> dict[str, int]:
        jobs = [(n, resolver.table(n), stored.path(n)) for n in names if n in wanted]
        return _write_zone(jobs, period, parallel, in_order) if jobs else {}

    counts: dict[str, int] = {}
    counts.update(zone(source, S.RAW_TABLES))
    counts.update(zone(from_store(S.RAW_TABLES), S.CLEANED_TABLES, in_order=True))
    counts.update(zone(from_store(S.CLEANED_TABLES), ["dim_date", "dim_city"]))
    if check_keys and "dim_date" in counts:
        assert_unique_date_keys(stored.table("dim_date"))
    counts.update(zone(from_store(S.CLEANED_TABLES + ["dim_date", "dim_city"]),
                       ["fct_weather_hourly", "fct_prices_hourly", "fct_generation_hourly"], in_order=True))
    return {n: counts[n] for n in S.ALL_TABLES if n in counts}


def export_curated(source: Tables, base: str, period: str = "year") -> dict[str, int]:
    """SNK-05: the five star tables to ``<base>/curated/<table>``.

    Spark writes straight to the target file system (object storage path
    included); nothing passes through the driver.
    """
    return {name: write_table(source.table(name), f"{base.rstrip('/')}/curated/{name}", name, period)
            for name in S.STAR_TABLES}


def write_raw(df: DataFrame, path: str, table: str, period: str = "year") -> int:
    """SNK-01..03: one raw table, with its declared schema enforced first."""
    from hourmart.sources.landing import check_raw_schema

    return write_table(check_raw_schema(df, table), path, table, period)


# Tables joined on the hour key; bucketing them alike makes those joins shuffle-free.
BUCKETED_ON_DATE_KEY = ["dim_date", "fct_weather_hourly", "fct_prices_hourly", "fct_generation_hourly"]


def save_star_as_bucketed_tables(spark: SparkSession, source: Tables, database: str, base: str,
                                 buckets: int = 64) -> dict[str, int]:
    """Star tables as catalog tables, every ``date_key`` table bucketed alike.

    ``dim_date`` and the three facts are written with ``bucketBy(buckets,
    "date_key")`` and sorted by it, so a fact-to-fact or fact-to-date join on
    ``date_key`` reads matching buckets side by side: a sort-merge join with
    no exchange on either side, however large the facts grow. ``dim_city``
    (the station list) is left unbucketed. Tables are external, stored under
    ``<base>/bucketed/<table>`` (a shared folder on a cluster).
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    counts: dict[str, int] = {}
    for name in S.STAR_TABLES:
        obs = Observation(f"rows_{name}")
        df = source.table(name).observe(obs, F.count(F.lit(1)).alias("rows"))
        w = df.write.mode("overwrite").format("parquet").option("path", f"{base.rstrip('/')}/bucketed/{name}")
        if name in BUCKETED_ON_DATE_KEY:
            w = w.bucketBy(buckets, "date_key").sortBy("date_key")
        w.saveAsTable(f"`{database}`.`{name}`")
        counts[name] = int(obs.get["rows"])
    return counts
