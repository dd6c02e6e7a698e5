"""Curated zone (TAB-04..08): star schema with two dimensions, three facts.

Join strategy: no broadcast hints. ``dim_city`` is the distinct station list
(bounded by the number of stations, not by hours); with AQE on, the planner
measures it after its shuffle and turns the join into a broadcast hash join
only when the measured size is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``,
and keeps the sort-merge join otherwise, salted for the cities measured to be heavy. ``dim_date`` grows with
history, so it is never forced to broadcast either.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourmart import schemas as S
from hourmart.functions import expr as X
from hourmart.operators.numbering import numbered


#: Places over which a heavy city's hours are spread in a shuffled join.
SALT = 64
#: A city with more than this part of all hours is heavy: it would fill more than its share of the tasks.
HEAVY_SHARE = 1 / 64


def dim_date(cleaned_weather: DataFrame) -> DataFrame:
    """One row per distinct weather timestamp with calendar attributes.

    Only the timestamp column is shuffled for the DISTINCT (partial
    aggregation map-side); the attributes are functions of it and are
    computed after. Hours without weather are absent, as in the source model.
    """
    t = F.col("timestamp")
    return (cleaned_weather.select("timestamp").distinct()
            .select(
                X.date_key(t).alias("date_key"),
                t.alias("timestamp"),
                F.year(t).alias("year"),
                F.month(t).alias("month"),
                F.dayofmonth(t).alias("day"),
                F.hour(t).alias("hour"),
                X.weekday0(t).alias("day_of_week"),
                F.dayofyear(t).alias("day_of_year"),
                X.month_name(t).alias("month_name"),
                X.day_name(t).alias("day_name"),
                X.is_weekend(t).alias("is_weekend"),
                X.season(F.month(t)).alias("season"),
                X.is_business_hours(t).alias("is_business_hours"),
            ))


#: What makes a station: differing coordinates make two.
STATION = ("city", "latitude", "longitude")


def dim_city(cleaned_weather: DataFrame) -> DataFrame:
    """Surrogate keys 1..n over the distinct (city, latitude, longitude) list, in that order.

    The list grows with the station network; it is numbered range by range
    (:func:`hourmart.operators.numbering.numbered`), never by one task.
    """
    return city_rows(cleaned_weather.select(*STATION).distinct())


def city_rows(stations: DataFrame) -> DataFrame:
    """``dim_city`` rows of a distinct station list."""
    return numbered(stations, list(STATION), "city_key").select(
        "city_key", *STATION,
        X.city_region(F.col("city")).alias("region"),
        X.is_coastal(F.col("city")).alias("is_coastal"),
    )


def heavy_cities(cleaned_weather: DataFrame, share: float = HEAVY_SHARE) -> list[str]:
    """Cities that hold more than ``share`` of all hours (fewer than 1 / share names), by one count per city."""
    counts = cleaned_weather.groupBy("city").agg(F.count(F.lit(1)).alias("c"))
    rows = F.lit(cleaned_weather.count())
    return sorted(r["city"] for r in counts.where((F.col("c") > rows * F.lit(share)) & F.col("city").isNotNull())
                  .select("city").collect())


def fct_weather_hourly(cleaned_weather: DataFrame, dim_city_df: DataFrame, heavy: list[str] | None = None) -> DataFrame:
    """Weather facts with their station's key.

    ``heavy``: the heavy cities, measured now (:func:`heavy_cities`) if not given. Where the join
    shuffles, only their hours go to SALT places and only their dimension rows
    are copied; every other city has one place, and the skew join of AQE splits
    what still is uneven.
    """
    heavy = heavy_cities(cleaned_weather) if heavy is None else heavy
    w = cleaned_weather.select(
        X.date_key("timestamp").alias("date_key"), "city",
        "shortwave_radiation_wm2", "windspeed_10m_kmh", "temperature_2m_c",
        "is_daytime", "radiation_category")
    cities = dim_city_df.select("city", "city_key")
    keys = ["city"]
    if heavy:
        keys = ["city", "_salt"]
        salted = F.col("city").isin(list(heavy))
        w = w.withColumn("_salt", F.when(salted, F.pmod(F.xxhash64("date_key"), F.lit(SALT))).otherwise(F.lit(0)))
        places = F.when(salted, F.lit(SALT - 1)).otherwise(F.lit(0)).cast("long")
        cities = cities.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), places)))
    return (w.join(cities, keys)
            .select("date_key", "city_key", "shortwave_radiation_wm2", "windspeed_10m_kmh",
                    "temperature_2m_c", "is_daytime", "radiation_category"))


def fct_prices_hourly(cleaned_prices: DataFrame) -> DataFrame:
    return cleaned_prices.select(
        X.date_key("timestamp").alias("date_key"),
        "price_eur_mwh", "price_category", "is_negative_price", "season", "hour")


def fct_generation_hourly(cleaned_generation: DataFrame) -> DataFrame:
    mw = [m for _, m in S.GENERATION_SOURCES]
    return cleaned_generation.select(
        X.date_key("timestamp").alias("date_key"),
        *mw,
        "total_generation_mw", "renewable_mw", "fossil_mw",
        X.share_pct("renewable_mw", "total_generation_mw", 2).alias("renewable_pct"),
        "season", "hour")
