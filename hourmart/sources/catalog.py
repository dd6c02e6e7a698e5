"""Table resolvers: one query code base over derived, stored or catalog tables.

A query function takes a resolver and asks it for tables by name
(``t.table("fct_prices_hourly")``). Which storage answers is a parameter:

* :class:`LayeredTables` derives cleaned and star tables lazily from three
  raw DataFrames (landed files, or the driver-table adapters).
* :class:`DerivedTables` is ``LayeredTables`` over the driver-table adapters.
* :class:`StoredTables` reads a warehouse written by
  :func:`hourmart.sinks.writer.build_warehouse` (``<base>/<zone>/<table>``).
* :class:`CatalogTables` reads ``<database>.<table>`` from the session catalog
  (external tables over object storage are registered with
  :func:`register_external_tables`).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourmart import schemas as S
from hourmart.operators import cleaned as C
from hourmart.operators import star as ST


PERIOD_COLUMNS = ("p_year", "p_month", "p_date")
#: What the refresh keeps beside a raw table's columns: the landing time of each row.
REFRESH_COLUMNS = ("_landed_at",)


class Tables:
    """Base resolver: ``table(name) -> DataFrame``."""

    spark: SparkSession

    def table(self, name: str) -> DataFrame:  # pragma: no cover - interface
        raise NotImplementedError

    def __getitem__(self, name: str) -> DataFrame:
        return self.table(name)

    def row_count(self, name: str) -> DataFrame:
        """One row: ``row_count`` of a table."""
        return self.table(name).agg(F.count(F.lit(1)).alias("row_count"))


def footer_rows(spark: SparkSession, path: str) -> DataFrame:
    """Parquet files whose row counts Spark answers from their footers (``PushedAggregation``).

    Only the second generation of the file source pushes aggregates down, and sources are chosen by a session
    setting, so the frame belongs to a session of its own beside ``spark`` (same context and catalog).
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own.read.parquet(path)


class LayeredTables(Tables):
    """Raw DataFrames in, every cleaned and star table derived lazily.

    Each derived DataFrame is built once and memoised, so a query that uses
    a table twice shares one logical subtree (and one exchange at run time).
    With ``measure`` heavy cities are counted when the weather fact is asked
    for (a warehouse build); without, nothing runs before the query does and
    the skew join of AQE alone splits them.
    """

    def __init__(self, spark: SparkSession, raw: dict[str, DataFrame],
                 loaders: dict[str, Callable[[], DataFrame]] | None = None, measure: bool = False):
        self.spark = spark
        self._measure = measure
        self._cache: dict[str, DataFrame] = dict(raw)
        self._loaders = dict(loaders or {})

    def table(self, name: str) -> DataFrame:
        if name in self._cache:
            return self._cache[name]
        if name in self._loaders:
            df = self._loaders[name]()
        elif name in C.BUILDERS:
            src, fn = C.BUILDERS[name]
            df = fn(self.table(src))
        elif name == "dim_date":
            df = ST.dim_date(self.table("cleaned_weather"))
        elif name == "dim_city":
            df = ST.dim_city(self.table("cleaned_weather"))
        elif name == "fct_weather_hourly":
            df = ST.fct_weather_hourly(self.table("cleaned_weather"), self.table("dim_city"),
                                       None if self._measure else [])
        elif name == "fct_prices_hourly":
            df = ST.fct_prices_hourly(self.table("cleaned_prices"))
        elif name == "fct_generation_hourly":
            df = ST.fct_generation_hourly(self.table("cleaned_generation"))
        else:
            raise KeyError(f"unknown table {name!r}")
        self._cache[name] = df
        return df


class DerivedTables(LayeredTables):
    """Raw tables from the driver's ``orders`` / ``lineitem`` (see driver_tables)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        from hourmart.sources.driver_tables import derive_raw

        super().__init__(spark, derive_raw(spark, sf_dir))
        self.sf_dir = sf_dir


class RawFiles(LayeredTables):
    """Landed raw Parquet files (one path per raw table), read with the
    declared schemas; cleaned and star tables derived from them."""

    def __init__(self, spark: SparkSession, paths: dict[str, str]):
        from hourmart.sources.landing import read_raw_parquet

        missing = [t for t in S.RAW_TABLES if t not in paths]
        if missing:
            raise ValueError(f"no path for {missing}")
        super().__init__(spark, {t: read_raw_parquet(spark, paths[t], t) for t in S.RAW_TABLES})


class StoredTables(Tables):
    """Parquet warehouse at ``<base>/<zone>/<table>``.

    Period partition columns (``p_year`` / ``p_month`` / ``p_date``) are
    storage layout, not data: they are dropped on read so a stored table has
    exactly the schema of its derived twin.
    """

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.base}/{S.ZONE_OF[name]}/{name}"

    def table(self, name: str) -> DataFrame:
        if name not in S.ZONE_OF:
            raise KeyError(f"unknown table {name!r}")
        df = self.spark.read.parquet(self.path(name))
        return df.drop(*[c for c in PERIOD_COLUMNS + REFRESH_COLUMNS if c in df.columns])


    def row_count(self, name: str) -> DataFrame:
        """The count from the files' footers: no column is read."""
        return footer_rows(self.spark, self.path(name)).agg(F.count(F.lit(1)).alias("row_count"))


class CatalogTables(Tables):
    def __init__(self, spark: SparkSession, database: str):
        self.spark = spark
        self.database = database

    def table(self, name: str) -> DataFrame:
        return self.spark.table(f"`{self.database}`.`{name}`")


def register_external_tables(spark: SparkSession, database: str, base: str,
                             tables: list[str] | None = None) -> list[str]:
    """CREATE TABLE ... USING parquet LOCATION for each stored table.

    Metadata only: no data is read or copied. Partitioned tables get their
    partition folders registered with ``RECOVER PARTITIONS``.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    done = []
    for name in tables or S.ALL_TABLES:
        loc = f"{base.rstrip('/')}/{S.ZONE_OF[name]}/{name}"
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}`")
        spark.sql(f"CREATE TABLE `{database}`.`{name}` USING parquet LOCATION '{loc}'")
        if _is_partitioned(spark, database, name):
            spark.sql(f"ALTER TABLE `{database}`.`{name}` RECOVER PARTITIONS")
        done.append(name)
    return done


def _is_partitioned(spark: SparkSession, database: str, name: str) -> bool:
    return any(c.isPartition for c in spark.catalog.listColumns(f"`{database}`.`{name}`"))


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """SHOW TABLES as a DataFrame (catalog metadata, not data)."""
    rows = [(t.name, t.database, t.tableType, bool(t.isTemporary))
            for t in spark.catalog.listTables(database)]
    return spark.createDataFrame(rows, "table_name string, database string, table_type string, is_temporary boolean") \
        .orderBy(F.col("table_name"))
