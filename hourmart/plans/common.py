"""Shared building blocks of the analytical plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourmart.sources.catalog import Tables

DEFAULT_CITY = "Sofia"


def city_key_of(t: Tables, city: str) -> Column:
    """Surrogate key of ``city`` as a scalar subquery (no driver round trip).

    Looked up by name instead of a literal key, so renumbering the station
    list cannot silently switch cities. An unknown city gives NULL (no rows);
    a city listed with two coordinate pairs (two keys) uses its first key.
    """
    return t.table("dim_city").where(F.col("city") == F.lit(city)).agg(F.min("city_key")).scalar()


def city_weather(t: Tables, city: str, *cols: str) -> DataFrame:
    """Weather facts of one city, filtered before any fact-to-fact join.

    Joining unfiltered weather would multiply every hour by the number of
    stations.
    """
    w = t.table("fct_weather_hourly").where(F.col("city_key") == city_key_of(t, city))
    return w.select("date_key", *cols) if cols else w


def with_dates(fact: DataFrame, t: Tables, *date_cols: str) -> DataFrame:
    """Inner join of a fact with ``dim_date`` on ``date_key``.

    Hours missing from ``dim_date`` (no weather that hour) drop out, as in
    the source model.
    """
    d = t.table("dim_date").select("date_key", *date_cols)
    return fact.join(d, "date_key")


def generation_prices(t: Tables, gen_cols: list[str], price_cols: list[str]) -> DataFrame:
    """Generation facts joined to price facts on the shared hour key.

    Both sides are hash-partitioned on ``date_key`` once; every further join
    on the same key reuses that partitioning (no extra exchange).
    """
    g = t.table("fct_generation_hourly").select("date_key", *gen_cols)
    p = t.table("fct_prices_hourly").select("date_key", *price_cols)
    return g.join(p, "date_key")
