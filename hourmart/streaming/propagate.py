"""Change propagation by period (SNK-07): cleaned and star tables follow a raw table's refresh.

A refresh tells which periods of a raw table it touched. Cleaned tables and
facts are partitioned by the same periods and derived row by row, so only
these partitions are read (their folders are named, nothing else is listed)
and replaced. The dimensions take what is new:

* ``dim_date``: hours that it lacks are appended; only its rows of the touched
  key ranges are read (pushed to the files' statistics).
* ``dim_city``: stations that it lacks. ``renumber`` numbers all anew in name
  order, as a full build does, and rewrites the weather fact only if a known
  station's key moved; ``append`` gives new stations the next keys, so that
  keys never change and no other period is touched.

Every step gives the same tables when it is run again, so a batch that is
replayed after a failure is harmless.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourmart import schemas as S
from hourmart.operators import cleaned as C
from hourmart.operators import star as ST
from hourmart.session import shared_dir
from hourmart.sinks.writer import DuplicateKeyError, partition_column, write_table
from hourmart.sources.catalog import StoredTables
from hourmart.sources.landing import read_partitions

FACT_OF = {"cleaned_weather": "fct_weather_hourly", "cleaned_prices": "fct_prices_hourly",
           "cleaned_generation": "fct_generation_hourly"}
NEW_STATIONS = ("renumber", "append")


def key_range(value, period: str) -> tuple[int, int]:
    """First and last hour key (yyyymmddhh) of a period."""
    if period == "date":
        day = int(str(value).replace("-", ""))
        return day * 100, day * 100 + 99
    width = 10 ** (6 if period == "year" else 4)
    return int(value) * width, int(value) * width + width - 1


def in_periods(key: Column, values: list, period: str) -> Column:
    ranges = [key.between(*map(F.lit, key_range(v, period))) for v in values]
    return reduce(lambda a, b: a | b, ranges)


def touched_rows(spark: SparkSession, stored: StoredTables, table: str, values: list, period: str, schema) -> DataFrame:
    """Rows of a stored table in the given periods, its columns without the period column."""
    rows = read_partitions(spark, stored.path(table), partition_column(table, period), values, schema)
    return rows.select(*[F.col(f"`{f.name}`") for f in schema.fields])


def add_hours(stored: StoredTables, weather: DataFrame, values: list, period: str) -> int:
    """Append the hours of ``weather`` that ``dim_date`` lacks; returns how many."""
    known = stored.table("dim_date").where(in_periods(F.col("date_key"), values, period)).select("date_key", "timestamp")
    hours = ST.dim_date(weather)  # a join by name puts the key first; files keep the table's order of columns
    fresh = hours.join(known, "timestamp", "left_anti").select(*hours.columns).checkpoint()
    twice = fresh.select("date_key").unionByName(known.select("date_key")).groupBy("date_key").count() \
        .where(F.col("count") > 1).limit(1).collect()
    if twice:
        raise DuplicateKeyError(f"dim_date: date_key {twice[0]['date_key']} would have two timestamps")
    return write_table(fresh, stored.path("dim_date"), "dim_date", mode="append")


def add_stations(stored: StoredTables, weather: DataFrame, new_stations: str = "renumber") -> bool:
    """Give stations of ``weather`` that ``dim_city`` lacks a key; True if known stations' keys moved."""
    if new_stations not in NEW_STATIONS:
        raise ValueError(f"new_stations must be one of {NEW_STATIONS}")
    known = stored.table("dim_city")
    place = ST.STATION
    same = reduce(lambda a, b: a & b, [F.col(f"w.{c}").eqNullSafe(F.col(f"k.{c}")) for c in place])
    fresh = weather.select(*place).distinct().alias("w").join(known.alias("k"), same, "left_anti").checkpoint()
    if not fresh.limit(1).count():
        return False
    if new_stations == "append":
        last = known.agg(F.coalesce(F.max("city_key"), F.lit(0))).first()[0]
        rows = ST.city_rows(fresh).withColumn("city_key", F.col("city_key") + F.lit(last))
        write_table(rows, stored.path("dim_city"), "dim_city", mode="append")
        return False
    # written beside first: it replaces what it is read from
    spark, aside = weather.sparkSession, f"{shared_dir(weather.sparkSession)}/dim_city-{uuid.uuid4().hex}"
    ST.city_rows(known.select(*place).unionByName(fresh)).write.parquet(aside)
    rows = spark.read.parquet(aside)
    moved = known.alias("k").join(rows.alias("w"), same).where(F.col("k.city_key") != F.col("w.city_key"))
    any_moved = bool(moved.limit(1).count())
    write_table(rows, stored.path("dim_city"), "dim_city")
    return any_moved


def refresh_dependants(spark: SparkSession, base: str, raw_table: str, values: list, period: str,
                       new_stations: str = "renumber") -> dict[str, int]:
    """Bring the cleaned and star tables of the warehouse at ``base`` up to the touched periods of a raw table.

    ``values``: the touched period values (a NULL period holds no cleaned rows). Returns the rows written per table.
    """
    stored = StoredTables(spark, base)
    values = [v for v in values if v is not None]
    if not values:
        return {}
    name = next(c for c, (src, _) in C.BUILDERS.items() if src == raw_table)
    raw = touched_rows(spark, stored, raw_table, values, period, S.RAW_SCHEMAS[raw_table])
    rows = C.BUILDERS[name][1](raw)
    written = {name: write_table(rows, stored.path(name), name, period, replace="periods")}
    cleaned = touched_rows(spark, stored, name, values, period, rows.schema)
    fact, replace = FACT_OF[name], "periods"
    if name == "cleaned_weather":
        written["dim_date"] = add_hours(stored, cleaned, values, period)
        if add_stations(stored, cleaned, new_stations):
            cleaned, replace = stored.table(name), "all"
        facts = ST.fct_weather_hourly(cleaned, stored.table("dim_city"))
    else:
        facts = ST.fct_prices_hourly(cleaned) if name == "cleaned_prices" else ST.fct_generation_hourly(cleaned)
    written[fact] = write_table(facts, stored.path(fact), fact, period, replace=replace, in_order=True)
    return written
