"""Ingest shaping run over data derived from the tables (SRC-05, ING-04, ING-10).

Each query turns a raw table into the landed form its feed delivers and
back through the ingest reader, so the reader runs on the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourmart.sources import landing as L
from hourmart.sources.catalog import Tables


def weather_landing_roundtrip(t: Tables) -> DataFrame:
    """raw_weather -> JSON responses (one per city and day) -> raw_weather rows."""
    lines = L.to_json_lines(L.weather_landing_docs(t.table("raw_weather")))
    return L.weather_rows(L.from_json_lines(lines))


def generation_long_to_wide(t: Tables) -> DataFrame:
    """raw_generation -> per-source rows (as a per-type feed lands) -> wide table."""
    return L.generation_wide(L.generation_long(t.table("raw_generation")))


def prices_utc_to_local(t: Tables) -> DataFrame:
    """Price hours read as UTC instants -> local wall clock (Europe/Sofia)."""
    p = t.table("raw_prices").select(F.col("timestamp").alias("timestamp_utc"),
                                     F.col("price_eur_mwh").alias("price"))
    return L.prices_from_utc(p)


def prices_in_request_range(t: Tables, start: str = "1995-01-01 00:00:00",
                            end: str = "1995-12-31 00:00:00") -> DataFrame:
    """ING-05: the price feed restricted to a request window (local time,
    end inclusive, as a day-ahead request from Jan 1 to Dec 31 returns it)."""
    return L.restrict_range(t.table("raw_prices"), start, end)
