"""Weather views (AGG-01, AGG-02, AGG-05, AGG-11, AGG-15, AGG-18, PRJ-30,
PRJ-31, FIL-07, SET-04)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourmart.functions.expr import half_away
from hourmart.plans.common import DEFAULT_CITY, city_weather, with_dates
from hourmart.sources.catalog import Tables


def city_radiation(t: Tables) -> DataFrame:
    """AGG-01: per city over the raw table, mean and peak radiation and hours."""
    return (t.table("raw_weather").groupBy("city")
            .agg(half_away(F.avg("shortwave_radiation_wm2"), 2).alias("avg_solar_radiation"),
                 half_away(F.max("shortwave_radiation_wm2"), 2).alias("max_solar_radiation"),
                 F.count(F.lit(1)).cast("long").alias("total_hours"))
            .orderBy(F.col("avg_solar_radiation").desc_nulls_last()))


def season_weather(t: Tables) -> DataFrame:
    """AGG-02: per season, mean radiation and temperature (cleaned table)."""
    return (t.table("cleaned_weather").groupBy("season")
            .agg(half_away(F.avg("shortwave_radiation_wm2"), 1).alias("avg_radiation"),
                 half_away(F.avg("temperature_2m_c"), 1).alias("avg_temperature"))
            .orderBy(F.col("avg_radiation").desc_nulls_last()))


def _weather_star(t: Tables, *date_cols: str) -> DataFrame:
    w = t.table("fct_weather_hourly").select("date_key", "city_key", "shortwave_radiation_wm2", "temperature_2m_c")
    c = t.table("dim_city").select("city_key", "city", "region", "is_coastal")
    return with_dates(w.join(c, "city_key"), t, *date_cols)


def summer_city_radiation(t: Tables, season: str = "Summer") -> DataFrame:
    """AGG-05: per city in one season, mean radiation and temperature.

    The season filter sits on the date dimension; Catalyst applies it before
    the join, so only that season's keys meet the fact.
    """
    ws = _weather_star(t, "season").where(F.col("season") == F.lit(season))
    return (ws.groupBy("city", "region", "is_coastal")
            .agg(half_away(F.avg("shortwave_radiation_wm2"), 1).alias("avg_solar_radiation"),
                 half_away(F.avg("temperature_2m_c"), 1).alias("avg_temperature"))
            .orderBy(F.col("avg_solar_radiation").desc_nulls_last()))


def city_month_radiation(t: Tables, with_region: bool = True) -> DataFrame:
    """AGG-11: mean radiation per city and month (long form, one series per city)."""
    keys = ["city", "region", "month_name", "month"] if with_region else ["city", "month", "month_name"]
    return (_weather_star(t, "month", "month_name").groupBy(*keys)
            .agg(half_away(F.avg("shortwave_radiation_wm2"), 1).alias("avg_radiation"))
            .orderBy(F.col("city").asc_nulls_last(), F.col("month").asc_nulls_last()))


def city_weather_kpis(t: Tables, city: str = DEFAULT_CITY) -> DataFrame:
    """AGG-15: one city's mean / peak radiation, mean temperature and wind."""
    w = city_weather(t, city)
    return w.agg(half_away(F.avg("shortwave_radiation_wm2"), 1).alias("avg_radiation"),
                 half_away(F.max("shortwave_radiation_wm2"), 1).alias("max_radiation"),
                 half_away(F.avg("temperature_2m_c"), 1).alias("avg_temp"),
                 half_away(F.avg("windspeed_10m_kmh"), 1).alias("avg_wind"))


def daily_radiation(t: Tables, city: str = DEFAULT_CITY, digits: int = 6) -> DataFrame:
    """AGG-18: daily mean radiation of one city.

    ``date`` is the day's midnight as an NTZ timestamp (a zone-free day key
    that every engine and client library hands over the same way).
    """
    w = t.table("raw_weather").where(F.col("city") == F.lit(city))
    return (w.groupBy(F.to_date("timestamp").cast("timestamp_ntz").alias("date"))
            .agg(half_away(F.avg("shortwave_radiation_wm2"), digits).alias("avg_radiation"))
            .orderBy(F.col("date").asc_nulls_last()))


def daytime_preview(t: Tables, n: int = 5) -> DataFrame:
    """PRJ-30: first ``n`` daytime rows of the cleaned table, in time order."""
    return (t.table("cleaned_weather").where(F.col("shortwave_radiation_wm2") > F.lit(0.0))
            .select("timestamp", "city", "shortwave_radiation_wm2", "hour", "month", "season",
                    "is_daytime", "radiation_category")
            .orderBy(F.col("timestamp").asc_nulls_last(), F.col("city").asc_nulls_last())
            .limit(n))


def raw_preview(t: Tables, n: int = 5) -> DataFrame:
    """PRJ-31: first ``n`` raw rows in time order (top-k, not a full sort)."""
    return (t.table("raw_weather")
            .orderBy(F.col("timestamp").asc_nulls_last(), F.col("city").asc_nulls_last())
            .limit(n))


def city_key_lookup(t: Tables, city: str = DEFAULT_CITY) -> DataFrame:
    """FIL-07: surrogate key of a city, by name."""
    return t.table("dim_city").where(F.col("city") == F.lit(city)).select("city_key")


def unique_cities(t: Tables) -> DataFrame:
    """SET-04: distinct city names present in the raw table."""
    return t.table("raw_weather").select("city").distinct().orderBy(F.col("city").asc_nulls_last())
