"""Catalogue of named queries: key -> function(Tables) -> DataFrame.

Keys are the inventory IDs in lower case (``agg_06_...``). Every query
takes a table resolver, so the same code runs over tables derived on the
fly, a stored warehouse or catalog tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from hourmart.plans import correlations as COR
from hourmart.plans import ingest_checks as ING
from hourmart.plans import mix as MIX
from hourmart.plans import prices as PR
from hourmart.plans import profile as PF
from hourmart.plans import seasonal as SEA
from hourmart.plans import weather as WX
from hourmart.sources.catalog import Tables

QueryFn = Callable[[Tables], DataFrame]


def _variant(fn: QueryFn, doc: str, **params) -> QueryFn:
    """``fn`` with fixed parameters (a published twin or another city)."""
    def q(t: Tables) -> DataFrame:
        return fn(t, **params)
    q.__doc__ = doc
    return q


def _table(name: str) -> QueryFn:
    def q(t: Tables) -> DataFrame:
        return t.table(name)
    q.__doc__ = f"The built table {name}."
    return q


QUERIES: dict[str, QueryFn] = {
    # raw zone (adapters / landed files)
    "src_01_raw_weather": _table("raw_weather"),
    "src_02_raw_prices": _table("raw_prices"),
    "src_03_raw_generation": _table("raw_generation"),
    # built tables
    "tab_01_cleaned_weather": _table("cleaned_weather"),
    "tab_02_cleaned_prices": _table("cleaned_prices"),
    "tab_03_cleaned_generation": _table("cleaned_generation"),
    "tab_04_dim_date": _table("dim_date"),
    "tab_05_dim_city": _table("dim_city"),
    "tab_06_fct_weather_hourly": _table("fct_weather_hourly"),
    "tab_07_fct_prices_hourly": _table("fct_prices_hourly"),
    "tab_08_fct_generation_hourly": _table("fct_generation_hourly"),
    # aggregations
    "agg_01_city_radiation": WX.city_radiation,
    "agg_02_season_weather": WX.season_weather,
    "agg_03_monthly_mix": MIX.monthly_mix,
    "agg_03_monthly_mix_dashboard": _variant(MIX.monthly_mix, "AGG-03 without the total column.", with_total=False),
    "agg_04_generation_shares": MIX.generation_shares,
    "agg_05_summer_city_radiation": WX.summer_city_radiation,
    "agg_06_seasonal_flagship": SEA.seasonal_weather_generation_price,
    "agg_07_hourly_price_stats": PR.hourly_price_stats,
    "agg_08_season_hour_prices": PR.season_hour_prices,
    "agg_09_seasonal_summary": SEA.seasonal_summary,
    "agg_10_seasonal_summary_display": SEA.seasonal_summary_display,
    "agg_11_city_month_radiation": WX.city_month_radiation,
    "agg_11_city_month_radiation_dashboard": _variant(WX.city_month_radiation, "AGG-11 without the region column.",
                                                      with_region=False),
    "agg_12_generation_kpis": MIX.generation_kpis,
    "agg_12_generation_kpis_insights": _variant(MIX.generation_kpis, "AGG-12 with the insights column names.",
                                                naming="insights"),
    "agg_12_generation_kpi_cards": MIX.generation_kpi_cards,
    "agg_13_price_kpis": PR.price_kpis,
    "agg_14_monthly_prices": PR.monthly_prices,
    "agg_15_city_weather_kpis": WX.city_weather_kpis,
    "agg_16_row_counts": PF.row_counts,
    "agg_17_price_by_renewable_bucket": COR.price_by_renewable_bucket,
    "agg_18_daily_radiation": WX.daily_radiation,
    "agg_19_hourly_reference_line": PR.hourly_reference_line,
    "prj_27_hourly_price_band": PR.hourly_price_band,
    "prj_27_monthly_price_band": PR.monthly_price_band,
    # joins
    "joi_08_price_renewable_pairs": COR.price_renewable_pairs,
    "joi_09_price_renewable_detail": COR.price_renewable_detail,
    # statistics and profiling
    "sta_01_corr_renewable_price_detail": COR.corr_renewable_price_detail,
    "sta_02_corr_renewable_price_pairs": COR.corr_renewable_price_pairs,
    "sta_03_solar_pairs": COR.solar_pairs,
    "sta_03_corr_solar": COR.corr_solar,
    "sta_04_wind_pairs": COR.wind_pairs,
    "sta_04_corr_wind": COR.corr_wind,
    "sta_05_negative_price_share": COR.negative_price_share,
    # the dashboard's city selector (FIL-06) with another station
    "fil_06_corr_solar_plovdiv": _variant(COR.corr_solar, "STA-03 r for Plovdiv.", city="Plovdiv"),
    "fil_06_wind_pairs_varna": _variant(COR.wind_pairs, "STA-04 pairs for Varna.", city="Varna"),
    "fil_06_city_weather_kpis_burgas": _variant(WX.city_weather_kpis, "AGG-15 for Burgas.", city="Burgas"),
    "sta_06_describe_prices": PF.describe_prices,
    "sta_06_describe_city_radiation": PF.describe_city_radiation,
    "sta_07_generation_null_counts": PF.generation_null_counts,
    "sta_08_prices_missing_total": PF.prices_missing_total,
    "sta_09_city_time_range": PF.city_time_range,
    "sta_10_duplicate_key_report": PF.duplicate_key_report,
    "sta_11_generation_source_means": PF.generation_source_means,
    "sta_12_table_shape": PF.table_shape,
    # sorts / top-k
    "srt_05_cheapest_dearest_hour": PR.cheapest_dearest_hour,
    "srt_06_most_volatile_hour": PR.most_volatile_hour,
    # reshape
    "rsh_01_price_heatmap": PR.price_heatmap,
    # projections, filters, sets
    "prj_30_daytime_preview": WX.daytime_preview,
    "prj_31_raw_preview": WX.raw_preview,
    "fil_07_city_key_lookup": WX.city_key_lookup,
    "set_04_unique_cities": WX.unique_cities,
    # ingest shaping over data derived from the tables
    "src_05_weather_landing_roundtrip": ING.weather_landing_roundtrip,
    "ing_10_generation_long_to_wide": ING.generation_long_to_wide,
    "ing_04_prices_utc_to_local": ING.prices_utc_to_local,
    "ing_05_prices_in_request_range": ING.prices_in_request_range,
}

FLAGSHIP = "agg_06_seasonal_flagship"
