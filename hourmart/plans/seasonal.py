"""Seasonal views over all three facts (AGG-06, AGG-09, AGG-10)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourmart.functions.expr import half_away
from hourmart.plans.common import DEFAULT_CITY, city_weather, generation_prices, with_dates
from hourmart.sources.catalog import Tables


def seasonal_weather_generation_price(t: Tables, city: str = DEFAULT_CITY) -> DataFrame:
    """AGG-06: per season, one city's radiation vs national solar, renewable
    share and price (four-way join on the hour key)."""
    w = city_weather(t, city, "shortwave_radiation_wm2")
    joined = with_dates(generation_prices(t, ["solar_mw", "renewable_pct"], ["price_eur_mwh"]), t, "season")
    return (joined.join(w, "date_key")
            .groupBy("season")
            .agg(half_away(F.avg("shortwave_radiation_wm2"), 1).alias("avg_solar_radiation"),
                 half_away(F.avg("solar_mw"), 1).alias("avg_solar_generation_mw"),
                 half_away(F.avg("renewable_pct"), 1).alias("avg_renewable_pct"),
                 half_away(F.avg("price_eur_mwh"), 2).alias("avg_price_eur_mwh"))
            .orderBy(F.col("avg_solar_radiation").desc_nulls_last()))


def _negative_hours():
    return F.count(F.when(F.col("is_negative_price"), F.lit(1))).cast("long")


def seasonal_summary(t: Tables) -> DataFrame:
    """AGG-09: per season, six generation averages, mean price and the
    number of negative-price hours."""
    joined = with_dates(
        generation_prices(t, ["renewable_pct", "solar_mw", "wind_onshore_mw", "nuclear_mw", "lignite_mw"],
                          ["price_eur_mwh", "is_negative_price"]), t, "season")
    return (joined.groupBy("season")
            .agg(half_away(F.avg("renewable_pct"), 1).alias("avg_renewable_pct"),
                 half_away(F.avg("solar_mw"), 1).alias("avg_solar_mw"),
                 half_away(F.avg("wind_onshore_mw"), 1).alias("avg_wind_mw"),
                 half_away(F.avg("nuclear_mw"), 1).alias("avg_nuclear_mw"),
                 half_away(F.avg("lignite_mw"), 1).alias("avg_lignite_mw"),
                 half_away(F.avg("price_eur_mwh"), 2).alias("avg_price"),
                 _negative_hours().alias("negative_price_hours"))
            .orderBy(F.col("avg_renewable_pct").desc_nulls_last()))


def seasonal_summary_display(t: Tables) -> DataFrame:
    """AGG-10: the seasonal summary with display column names."""
    joined = with_dates(
        generation_prices(t, ["renewable_pct", "solar_mw", "wind_onshore_mw"],
                          ["price_eur_mwh", "is_negative_price"]), t, "season")
    return (joined.groupBy("season")
            .agg(half_away(F.avg("renewable_pct"), 1).alias("Renewable %"),
                 half_away(F.avg("solar_mw"), 0).alias("Avg Solar MW"),
                 half_away(F.avg("wind_onshore_mw"), 0).alias("Avg Wind MW"),
                 half_away(F.avg("price_eur_mwh"), 2).alias("Avg Price EUR/MWh"),
                 _negative_hours().alias("Negative Price Hours"))
            .withColumnRenamed("season", "Season")
            .orderBy(F.col("`Renewable %`").desc_nulls_last()))
