"""Join-based pair frames and their statistics (JOI-08, JOI-09, STA-01..05,
AGG-17).

The reference pulls each joined pair frame into local memory and computes
correlations, buckets and counts there. Here they are aggregates inside the
plan: a correlation is five partial moments per task, combined in one tiny
final stage, so no unaggregated join result ever reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourmart.functions.expr import bucket, half_away
from hourmart.functions.stats import safe_corr
from hourmart.plans.common import DEFAULT_CITY, city_weather, generation_prices, with_dates
from hourmart.sources.catalog import Tables

CORR_DIGITS = 6


def price_renewable_pairs(t: Tables) -> DataFrame:
    """JOI-08: (renewable share, price) for every hour with both facts."""
    return generation_prices(t, ["renewable_pct"], ["price_eur_mwh"]).select("renewable_pct", "price_eur_mwh")


def price_renewable_detail(t: Tables, city: str = DEFAULT_CITY) -> DataFrame:
    """JOI-09: hour-level detail over generation, prices, dates and one
    city's radiation (hours without that city's weather drop out)."""
    gp = generation_prices(t, ["renewable_pct", "solar_mw", "wind_onshore_mw", "fossil_mw", "total_generation_mw"],
                           ["price_eur_mwh", "is_negative_price"])
    w = city_weather(t, city, "shortwave_radiation_wm2")
    return (with_dates(gp, t, "month", "month_name", "hour").join(w, "date_key")
            .select("month", "month_name", "hour", "renewable_pct", "solar_mw", "wind_onshore_mw",
                    "fossil_mw", "total_generation_mw", "price_eur_mwh", "is_negative_price",
                    "shortwave_radiation_wm2"))


def corr_renewable_price_detail(t: Tables, city: str = DEFAULT_CITY) -> DataFrame:
    """STA-01: Pearson r of renewable share vs price over the JOI-09 rows."""
    d = price_renewable_detail(t, city)
    return d.agg(half_away(safe_corr("renewable_pct", "price_eur_mwh"), CORR_DIGITS).alias("r_renewable_price"),
                 F.count(F.lit(1)).cast("long").alias("n_rows"))


def corr_renewable_price_pairs(t: Tables) -> DataFrame:
    """STA-02: the same r over the JOI-08 rows (no weather condition)."""
    d = price_renewable_pairs(t)
    return d.agg(half_away(safe_corr("renewable_pct", "price_eur_mwh"), CORR_DIGITS).alias("r_renewable_price"),
                 F.count(F.lit(1)).cast("long").alias("n_rows"))


def solar_pairs(t: Tables, city: str = DEFAULT_CITY) -> DataFrame:
    """STA-03 frame: daytime radiation of one city vs national solar output."""
    g = t.table("fct_generation_hourly").select("date_key", "solar_mw")
    w = city_weather(t, city, "shortwave_radiation_wm2").where(F.col("shortwave_radiation_wm2") > F.lit(0.0))
    return (with_dates(g, t, "month", "month_name").join(w, "date_key")
            .select("shortwave_radiation_wm2", "solar_mw", "month", "month_name"))


def corr_solar(t: Tables, city: str = DEFAULT_CITY) -> DataFrame:
    """STA-03: Pearson r of radiation vs solar output (daytime hours)."""
    return solar_pairs(t, city).agg(
        half_away(safe_corr("shortwave_radiation_wm2", "solar_mw"), CORR_DIGITS).alias("r_radiation_solar"),
        F.count(F.lit(1)).cast("long").alias("n_rows"))


def wind_pairs(t: Tables, city: str = DEFAULT_CITY) -> DataFrame:
    """STA-04 frame: one city's wind speed vs national wind output, by season."""
    g = t.table("fct_generation_hourly").select("date_key", "wind_onshore_mw")
    w = city_weather(t, city, "windspeed_10m_kmh")
    return (with_dates(g, t, "season").join(w, "date_key")
            .select("windspeed_10m_kmh", "wind_onshore_mw", "season"))


def corr_wind(t: Tables, city: str = DEFAULT_CITY) -> DataFrame:
    """STA-04: Pearson r of wind speed vs wind output."""
    return wind_pairs(t, city).agg(
        half_away(safe_corr("windspeed_10m_kmh", "wind_onshore_mw"), CORR_DIGITS).alias("r_wind_generation"),
        F.count(F.lit(1)).cast("long").alias("n_rows"))


def negative_price_share(t: Tables, city: str = DEFAULT_CITY) -> DataFrame:
    """STA-05: negative-price hours and their share (%) of the JOI-09 rows."""
    d = price_renewable_detail(t, city)
    neg = F.sum(F.col("is_negative_price").cast("long"))
    total = F.count(F.lit(1))
    return d.agg(F.coalesce(neg, F.lit(0)).cast("long").alias("negative_hours"),
                 total.cast("long").alias("total_hours"),
                 half_away(neg / F.nullif(total, F.lit(0)) * F.lit(100.0), 1).alias("negative_pct"))


def price_by_renewable_bucket(t: Tables, city: str = DEFAULT_CITY, width: int = 10) -> DataFrame:
    """AGG-17: mean price per renewable-share bucket (0-10 %, 10-20 %, ...).

    Hours without a renewable share (no output) have no bucket and are left
    out rather than failing the integer cast.
    """
    d = price_renewable_detail(t, city).where(F.col("renewable_pct").isNotNull())
    return (d.groupBy(bucket("renewable_pct", width).alias("renewable_bucket"))
            .agg(half_away(F.avg("price_eur_mwh"), CORR_DIGITS).alias("avg_price"),
                 F.count(F.lit(1)).cast("long").alias("n_hours"))
            .orderBy(F.col("renewable_bucket").asc_nulls_last()))
