"""Queries that write their whole input under the shared folder and read it back (SRC, SNK, ING, SRT, SET).

Each takes a table resolver like the catalogue's queries, but runs its writes
when it is called. The written tables lie in a new folder under
``spark.checkpoint.dir``; a cluster should empty it between applications.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourmart import schemas as S
from hourmart.functions.stats import numeric_columns
from hourmart.plans.profile import row_counts
from hourmart.plans.registry import FLAGSHIP, QUERIES
from hourmart.session import kept_aside, shared_dir
from hourmart.sinks.writer import build_warehouse, export_curated, write_raw, write_table
from hourmart.sources import landing as L
from hourmart.sources.catalog import CatalogTables, LayeredTables, StoredTables, Tables, list_tables, register_external_tables

DATABASE = "hourmart_external"


def _folder(t: Tables, name: str) -> str:
    return f"{shared_dir(t.spark)}/{name}-{uuid.uuid4().hex}"


def _raw_round_trip(table: str) -> Callable[[Tables], DataFrame]:
    def q(t: Tables) -> DataFrame:
        path = _folder(t, table)
        write_raw(t.table(table), path, table)
        return L.read_raw_parquet(t.spark, path, table)
    q.__doc__ = f"{table} written with its declared schema and read by the raw reader."
    return q


def replaced_table(t: Tables) -> DataFrame:
    """SNK-04: a first, smaller content is replaced; the stored table is scanned (SRC-06)."""
    stored = StoredTables(t.spark, _folder(t, "replaced"))
    rows = t.table("cleaned_prices")
    for part in (rows.where(F.col("hour") < 6), rows):
        write_table(part, stored.path("cleaned_prices"), "cleaned_prices")
    return stored.table("cleaned_prices")


def curated_export(t: Tables) -> DataFrame:
    """SNK-05: the five star tables exported, and counted as the files hold them."""
    base = _folder(t, "export")
    export_curated(t, base)
    return _counted(StoredTables(t.spark, base), S.STAR_TABLES)


def _counted(t: Tables, names: list[str]) -> DataFrame:
    parts = [t.table(n).agg(F.count(F.lit(1)).cast("long").alias("row_count"))
             .select(F.lit(n).alias("table_name"), "row_count") for n in names]
    return reduce(DataFrame.unionByName, parts)


def flagship_on_stored(t: Tables) -> DataFrame:
    """SRC-08: the flagship query's own code over a warehouse built from ``t``."""
    base = _folder(t, "warehouse")
    build_warehouse(t.spark, t, base)
    return QUERIES[FLAGSHIP](StoredTables(t.spark, base))


def stored_counts(t: Tables) -> DataFrame:
    """AGG-16 over a stored warehouse: rows per table, counted from the files' footers."""
    base = _folder(t, "counted")
    build_warehouse(t.spark, t, base)
    return row_counts(StoredTables(t.spark, base))


def _external(t: Tables, names: list[str]) -> str:
    stored = StoredTables(t.spark, _folder(t, "external"))
    for n in names:
        write_table(t.table(n), stored.path(n), n)
    register_external_tables(t.spark, DATABASE, stored.base, names)
    return DATABASE


def external_table(t: Tables) -> DataFrame:
    """SRC-07: a fact as an external table of the catalog."""
    rows = CatalogTables(t.spark, _external(t, ["fct_prices_hourly"])).table("fct_prices_hourly")
    return rows.select(*t.table("fct_prices_hourly").columns)


def listed_tables(t: Tables) -> DataFrame:
    """SRC-09: the tables the catalog lists, with their rows."""
    names = ["cleaned_prices", "fct_prices_hourly"]
    database = _external(t, names)
    listed = list_tables(t.spark, database).where(F.col("table_name").isin(names)).select("table_name")
    return listed.join(_counted(CatalogTables(t.spark, database), names), "table_name")


def _landed_weather(rows: DataFrame, path: str) -> None:
    """JSON lines, a response per city and day; no file holds more than some thousand."""
    L.to_json_lines(L.weather_landing_docs(rows)).write.option("maxRecordsPerFile", 5000).text(path)


def _landed_twice(rows: DataFrame, path: str) -> None:
    """Landed responses of the hours from noon on (folder ``load=0``) and of all hours (``load=1``), from one grouping.

    A task writes its days' later hours before it writes the whole days, so of every hour they land in this order.
    """
    later = F.filter("_rows", lambda r: F.substring(r["time"], 12, 2) >= F.lit("12"))
    loads = F.array(*[F.struct(F.lit(i).alias("load"), r.alias("_rows")) for i, r in enumerate((later, F.col("_rows")))])
    days = L.weather_days(rows).select("city", "latitude", "longitude", F.inline(loads)).where(F.size("_rows") > 0)
    docs = L.days_as_docs(days, keep=("load",))
    docs.select("load", F.to_json(F.struct(*[c for c in docs.columns if c != "load"])).alias("value")) \
        .write.partitionBy("load").option("maxRecordsPerFile", 5000).text(path)


def refresh_out_of_order(t: Tables) -> DataFrame:
    """SNK-07: the later half of the hours is loaded first, then all; the table equals a load in one."""
    from hourmart.streaming.refresh import load_weather_files

    base = _folder(t, "refresh")
    _landed_twice(t.table("raw_weather"), f"{base}/landed")
    for i in (0, 1):
        load_weather_files(t.spark, f"{base}/landed/load={i}", f"{base}/raw_weather", period="year", multi_line=False)
    return L.read_raw_parquet(t.spark, f"{base}/raw_weather", "raw_weather")


#: What becomes of a response by (day number + length of the city's name) modulo 13; the others stay whole.
DAMAGES = {0: "not_json", 1: "no_city", 2: "bad_time", 3: "no_hours", 4: "wrong_type"}


def _damaged(docs: DataFrame) -> DataFrame:
    """Landing documents as JSON texts (column ``value``), some of them spoilt (stand-in input only)."""
    text, day = F.to_json(F.struct(*docs.columns)), F.to_date(F.substring(F.col("hourly.time")[0], 1, 10))
    case = F.pmod(F.unix_date(day) + F.char_length("city"), F.lit(13))
    spoilt = {0: F.substring(text, 1, 60), 1: F.to_json(F.struct(*[c for c in docs.columns if c != "city"])),
              2: F.replace(text, F.lit('"time":["'), F.lit('"time":["x')), 3: F.to_json(F.struct("city", F.lit(True).alias("error"))),
              4: F.replace(text, F.lit('"shortwave_radiation":['), F.lit('"shortwave_radiation":["n/a",'))}
    value = reduce(lambda rest, k: F.when(case == k, spoilt[k]).otherwise(rest), spoilt, text)
    return docs.select(value.alias("value"))


def rejected_responses(t: Tables) -> DataFrame:
    """SRC-05, SET-03, ING-01: a stream over landed responses, some of them bad, goes on; its table's rows, and the
    rejects table counted by reason. Loading the folder once more adds no reject."""
    from hourmart.sources.rejects import read_rejects
    from hourmart.streaming.refresh import load_weather_files, start_refresh

    base = _folder(t, "judged")
    _damaged(L.weather_landing_docs(t.table("raw_weather"))).write.option("maxRecordsPerFile", 5000).text(f"{base}/landed")
    start_refresh(t.spark, "weather", f"{base}/landed", f"{base}/raw_weather", f"{base}/stream", period="year",
                  multi_line=False, rejects=f"{base}/rejects").awaitTermination()
    load_weather_files(t.spark, f"{base}/landed", f"{base}/raw_weather", multi_line=False, rejects=f"{base}/rejects")
    rows = L.read_raw_parquet(t.spark, f"{base}/raw_weather", "raw_weather")
    counts = read_rejects(t.spark, f"{base}/rejects").groupBy("reason").agg(F.count(F.lit(1)).alias("n_responses"))
    loaded = rows.select(F.lit("loaded").alias("outcome"), "timestamp", "city", "temperature_2m_c")
    nothing = [F.lit(None).cast(loaded.schema[c].dataType).alias(c) for c in loaded.columns[1:]]
    return loaded.withColumn("n_responses", F.lit(None).cast("long")).union(
        counts.select("reason", *nothing, "n_responses"))


def star_after_refresh(t: Tables) -> DataFrame:
    """SNK-07 with TAB-01..08: a warehouse built without the last year and without the afternoons of its first
    one; these are refreshed (weather landed and streamed, market rows merged), and the star tables, which followed
    by period, are read as one wide table."""
    from hourmart.streaming.propagate import refresh_dependants
    from hourmart.streaming.refresh import merge_touched, start_refresh

    spark, base = t.spark, _folder(t, "followed")
    stored = StoredTables(spark, base)
    # derived once: the build, the landing and the merges read them from there
    with ThreadPoolExecutor(len(S.RAW_TABLES)) as pool:
        raw = dict(zip(S.RAW_TABLES, pool.map(lambda n: kept_aside(t.table(n), n), S.RAW_TABLES)))
    ends = raw["raw_weather"].agg(F.min(F.year("timestamp")).alias("lo"), F.max(F.year("timestamp")).alias("hi")).first()
    year = F.year("timestamp")
    late = (year == F.lit(ends["hi"])) | ((year == F.lit(ends["lo"])) & (F.hour("timestamp") >= 12))
    with ThreadPoolExecutor(1) as pool:
        landed = pool.submit(_landed_weather, raw["raw_weather"].where(late), f"{base}-landed")
        build_warehouse(spark, LayeredTables(spark, {n: df.where(~late) for n, df in raw.items()}), base)
        landed.result()

    def weather() -> None:
        start_refresh(spark, "weather", f"{base}-landed", stored.path("raw_weather"), f"{base}-stream", multi_line=False,
                      warehouse=base).awaitTermination()

    def market(name: str) -> None:
        rows = raw[name].where(late).withColumn("_landed_at", F.lit(0))
        _, touched, period = merge_touched(rows, stored.path(name), name, ["timestamp"])
        refresh_dependants(spark, base, name, touched, period)

    # the feeds touch different tables, so they are refreshed side by side
    with ThreadPoolExecutor(3) as pool:
        for done in (pool.submit(weather), pool.submit(market, "raw_prices"), pool.submit(market, "raw_generation")):
            done.result()
    wide = stored.table("fct_weather_hourly").join(stored.table("dim_city").select("city_key", "city", "region"), "city_key") \
        .join(stored.table("dim_date").select("date_key", "timestamp", "month_name"), "date_key")
    prices = stored.table("fct_prices_hourly").select("date_key", "price_eur_mwh", "price_category")
    generation = stored.table("fct_generation_hourly").select("date_key", "total_generation_mw", "renewable_pct")
    return wide.join(prices, "date_key", "left").join(generation, "date_key", "left")


def landed_files_union(t: Tables) -> DataFrame:
    """SET-03: the responses of all cities, in many files, read as one table by the landing reader (SRC-05)."""
    path = _folder(t, "landed")
    _landed_weather(t.table("raw_weather"), path)
    return L.read_weather_landing(t.spark, path)


def time_ordered_files(t: Tables) -> DataFrame:
    """SRT-03: rows of the written weather fact, and how many stand before an earlier hour of the same file."""
    path = _folder(t, "ordered")
    write_table(t.table("fct_weather_hourly"), path, "fct_weather_hourly")
    rows = t.spark.read.parquet(path).select(
        "date_key", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    after = F.lead("date_key").over(Window.partitionBy("file").orderBy("at"))
    return rows.select("date_key", (after < F.col("date_key")).alias("late")).agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if("late").alias("out_of_order"))


def station_coordinates(t: Tables) -> DataFrame:
    """ING-02: the known stations' coordinates, removed and filled in again."""
    known = F.col("city").isin([c for c, _, _ in S.CITIES])
    bare = t.table("raw_weather").withColumns(
        {c: F.when(~known, F.col(c)) for c in ("latitude", "longitude")})
    return L.with_city_attributes(bare)


def flat_headers(t: Tables) -> DataFrame:
    """ING-07: generation under two-level headers (source, measure), flattened."""
    raw = t.table("raw_generation")
    two = [F.struct(F.col(f"`{s}`").alias("mw")).alias(s) for s, _ in S.GENERATION_SOURCES]
    return L.flatten_headers(raw.select("timestamp", *two, "country"))


def numeric_generation(t: Tables) -> DataFrame:
    """ING-09: the generation table's numeric columns, found by type."""
    raw = t.table("raw_generation")
    return raw.select(*[F.col(f"`{c}`") for c in numeric_columns(raw)])


STORAGE_QUERIES: dict[str, Callable[[Tables], DataFrame]] = {
    "agg_16_stored_counts": stored_counts,
    "snk_01_raw_weather_files": _raw_round_trip("raw_weather"),
    "snk_02_raw_prices_files": _raw_round_trip("raw_prices"),
    "snk_03_raw_generation_files": _raw_round_trip("raw_generation"),
    "snk_04_replaced_table": replaced_table,
    "snk_05_curated_export": curated_export,
    "snk_07_refresh_out_of_order": refresh_out_of_order,
    "snk_07_star_after_refresh": star_after_refresh,
    "src_05_rejected_responses": rejected_responses,
    "src_07_external_table": external_table,
    "src_08_flagship_on_stored": flagship_on_stored,
    "src_09_listed_tables": listed_tables,
    "srt_03_time_ordered_files": time_ordered_files,
    "set_03_landed_files_union": landed_files_union,
    "ing_02_station_coordinates": station_coordinates,
    "ing_07_flat_headers": flat_headers,
    "ing_09_numeric_columns": numeric_generation,
}
