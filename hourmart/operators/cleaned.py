"""Cleaned zone (TAB-01..03): raw table -> cleaned table.

Every builder is a single narrow projection plus the NULL-timestamp filter:
no shuffle, so it runs at scan speed and keeps the input partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourmart import schemas as S
from hourmart.functions import expr as X


def _require(df: DataFrame, columns: list[str], table: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{table}: missing input column(s) {missing}; found {df.columns}")


def time_parts(ts: str = "timestamp", with_day_of_year: bool = True) -> list:
    t = F.col(ts)
    parts = [
        F.year(t).alias("year"),
        F.month(t).alias("month"),
        F.dayofmonth(t).alias("day"),
        F.hour(t).alias("hour"),
        X.weekday0(t).alias("day_of_week"),
    ]
    if with_day_of_year:
        parts.append(F.dayofyear(t).alias("day_of_year"))
    parts.append(X.season(F.month(t)).alias("season"))
    return parts


def cleaned_weather(raw: DataFrame) -> DataFrame:
    cols = ["timestamp", "city", "latitude", "longitude",
            "shortwave_radiation_wm2", "windspeed_10m_kmh", "temperature_2m_c"]
    _require(raw, cols, "cleaned_weather")
    rad = F.col("shortwave_radiation_wm2")
    return (raw.where(F.col("timestamp").isNotNull())
            .select(*cols, *time_parts(),
                    X.is_daytime(rad).alias("is_daytime"),
                    X.radiation_category(rad).alias("radiation_category")))


def cleaned_prices(raw: DataFrame) -> DataFrame:
    _require(raw, ["timestamp", "price_eur_mwh", "country"], "cleaned_prices")
    price = F.col("price_eur_mwh")
    return (raw.where(F.col("timestamp").isNotNull())
            .select("timestamp", "price_eur_mwh", "country",
                    *time_parts(with_day_of_year=False),
                    X.price_category(price).alias("price_category"),
                    X.is_negative_price(price).alias("is_negative_price")))


def cleaned_generation(raw: DataFrame) -> DataFrame:
    sources = [src for src, _ in S.GENERATION_SOURCES]
    _require(raw, ["timestamp", "country", *sources], "cleaned_generation")
    renamed = [F.col(f"`{src}`").alias(mw) for src, mw in S.GENERATION_SOURCES]
    all_mw = [mw for _, mw in S.GENERATION_SOURCES]
    return (raw.where(F.col("timestamp").isNotNull())
            .select("timestamp", "country", *renamed, *time_parts(with_day_of_year=False))
            .withColumns({
                "total_generation_mw": X.coalesce_sum(all_mw),
                "renewable_mw": X.coalesce_sum(S.RENEWABLE_SOURCES),
                "fossil_mw": X.coalesce_sum(S.FOSSIL_SOURCES),
            }))


BUILDERS = {
    "cleaned_weather": ("raw_weather", cleaned_weather),
    "cleaned_prices": ("raw_prices", cleaned_prices),
    "cleaned_generation": ("raw_generation", cleaned_generation),
}
