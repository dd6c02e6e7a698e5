"""Adapters: the driver's TPC-H-like tables -> the three raw energy tables.

The test data holds orders and line items, not market feeds. These adapters
derive hourly raw tables from them with pick/count rules only (max, min,
max_by, modulo), so any engine computing them gets bit-identical values.

* hour slot: ``date(d) + (key % 24) hours``: the real date, so hours grow with
  the dates that the data covers. Prices and generation are hourly by the model.
* raw_prices: orders, d = o_orderdate, key = o_orderkey, one row per slot;
  price = o_totalprice of the largest o_orderkey / 1000 - 100.
* raw_weather: lineitem, d = l_shipdate, key = l_orderkey, one row per
  (slot, station); station = l_suppkey % 5 for even l_suppkey (the five known
  cities), else 5 + l_suppkey (a station of its own, of no known region), so
  the table grows with the suppliers; radiation = cents(max price) % 900 for hours 6-20
  else 0; wind = cents(min price) % 400 / 10; temperature =
  cents(max price) % 450 / 10 - 10; station i < 5 = i-th city by name, a
  station k of its own is at (42 + k % 1000 / 1000, 23 + k % 3000 / 1000).
* raw_generation: lineitem, one row per slot; source i =
  max(l_extendedprice where l_partkey % 11 = i) / 100, NULL when absent.

All three are one ``groupBy`` each: partial aggregation runs map-side, so
the shuffle carries at most (tasks x slots) rows, never the line items.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourmart import schemas as S

N_STATIONS = 5
N_SOURCES = len(S.GENERATION_SOURCES)


def read_driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def hour_slot(day: Column, key: Column) -> Column:
    return F.to_date(day).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), (key % F.lit(24)).cast("int"))


def station_of(suppkey: Column) -> Column:
    own = F.lit(N_STATIONS) + suppkey
    return F.when(suppkey % F.lit(2) == 0, suppkey % F.lit(N_STATIONS)).otherwise(own).cast("long")


def _cents(c: Column) -> Column:
    return F.round(c * F.lit(100.0)).cast("long")


def stations_by_index() -> list[tuple[str, float, float]]:
    """Station i of the adapter is the i-th city in name order."""
    return sorted(S.CITIES, key=lambda c: c[0])


def raw_prices(orders: DataFrame) -> DataFrame:
    slot = hour_slot(F.col("o_orderdate"), F.col("o_orderkey"))
    return (orders
            .select(slot.alias("timestamp"), "o_orderkey", "o_totalprice")
            .groupBy("timestamp")
            .agg(F.max_by("o_totalprice", "o_orderkey").alias("_price"))
            .select(
                "timestamp",
                (F.col("_price") / F.lit(1000.0) - F.lit(100.0)).cast("double").alias("price_eur_mwh"),
                F.lit(S.MARKET_COUNTRY).alias("country"),
                F.lit(S.MARKET_CURRENCY).alias("currency"),
                F.lit(S.MARKET_UNIT).alias("unit"),
            ))


def raw_weather(lineitem: DataFrame) -> DataFrame:
    slot = hour_slot(F.col("l_shipdate"), F.col("l_orderkey"))
    stations = stations_by_index()

    station = F.col("_station")
    own = station - F.lit(N_STATIONS)

    def pick(i: int, other: Column) -> Column:
        known = F.get(F.array(*[F.lit(s[i]) for s in stations]), station.cast("int"))
        return F.when(station < N_STATIONS, known).otherwise(other)

    hi, lo = F.col("_cmax"), F.col("_cmin")
    return (lineitem
            .select(slot.alias("timestamp"), station_of(F.col("l_suppkey")).alias("_station"),
                    "l_extendedprice")
            .groupBy("timestamp", "_station")
            .agg(_cents(F.max("l_extendedprice")).alias("_cmax"),
                 _cents(F.min("l_extendedprice")).alias("_cmin"))
            .select(
                "timestamp",
                F.when(F.hour("timestamp").between(6, 20), hi % F.lit(900)).otherwise(F.lit(0))
                 .cast("double").alias("shortwave_radiation_wm2"),
                (lo % F.lit(400) / F.lit(10)).cast("double").alias("windspeed_10m_kmh"),
                (hi % F.lit(450) / F.lit(10) - F.lit(10)).cast("double").alias("temperature_2m_c"),
                pick(0, F.concat(F.lit("Station "), own.cast("string"))).alias("city"),
                pick(1, F.lit(42.0) + (own % F.lit(1000)).cast("double") / F.lit(1000.0)).cast("double").alias("latitude"),
                pick(2, F.lit(23.0) + (own % F.lit(3000)).cast("double") / F.lit(1000.0)).cast("double").alias("longitude"),
            ))


def raw_generation(lineitem: DataFrame) -> DataFrame:
    slot = hour_slot(F.col("l_shipdate"), F.col("l_orderkey"))
    source = F.col("l_partkey") % F.lit(N_SOURCES)
    sources = [
        (F.max(F.when(F.col("_source") == F.lit(i), F.col("l_extendedprice"))) / F.lit(100.0))
        .cast("double").alias(name)
        for i, (name, _) in enumerate(S.GENERATION_SOURCES)
    ]
    return (lineitem
            .select(slot.alias("timestamp"), source.alias("_source"), "l_extendedprice")
            .groupBy("timestamp")
            .agg(*sources)
            .withColumn("country", F.lit(S.MARKET_COUNTRY)))


def derive_raw(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The three raw tables, lazily, from ``orders`` and ``lineitem``."""
    orders = read_driver_table(spark, sf_dir, "orders")
    lineitem = read_driver_table(spark, sf_dir, "lineitem")
    return {
        "raw_weather": raw_weather(lineitem),
        "raw_prices": raw_prices(orders),
        "raw_generation": raw_generation(lineitem),
    }
