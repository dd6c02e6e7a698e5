"""Schemas and fixed domain values.

Everything in the block marked FIXED VALUES must stay exactly as written:
the results of the analytical queries depend on these names, lists and
numbers (source names as they appear in landed generation files, the city
list with coordinates, region names, category edges).
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the published data model)
# ---------------------------------------------------------------------------

# Generation source columns of the landed file, in file order, and the
# analysis name each one gets in the cleaned table.
GENERATION_SOURCES: list[tuple[str, str]] = [
    ("Nuclear", "nuclear_mw"),
    ("Fossil Brown coal/Lignite", "lignite_mw"),
    ("Solar", "solar_mw"),
    ("Fossil Gas", "gas_mw"),
    ("Hydro Water Reservoir", "hydro_reservoir_mw"),
    ("Wind Onshore", "wind_onshore_mw"),
    ("Hydro Run-of-river and poundage", "hydro_river_mw"),
    ("Fossil Hard coal", "hard_coal_mw"),
    ("Biomass", "biomass_mw"),
    ("Waste", "waste_mw"),
    ("Hydro Pumped Storage", "hydro_pumped_mw"),
]

# Renewable = solar + wind + hydro reservoir + hydro run-of-river.
# Pumped storage and biomass are part of the total but not of this sum.
RENEWABLE_SOURCES: list[str] = ["solar_mw", "wind_onshore_mw", "hydro_reservoir_mw", "hydro_river_mw"]

# Fossil = lignite + gas + hard coal.
FOSSIL_SOURCES: list[str] = ["lignite_mw", "gas_mw", "hard_coal_mw"]

# Weather stations: city, latitude, longitude.
CITIES: list[tuple[str, float, float]] = [
    ("Sofia", 42.7065, 23.3219),
    ("Plovdiv", 42.1354, 24.7453),
    ("Varna", 43.2141, 27.9147),
    ("Burgas", 42.5048, 27.4626),
    ("Pleven", 43.4170, 24.6167),
]

# Region per city; a city not listed here gets a NULL region.
CITY_REGIONS: dict[str, str] = {
    "Sofia": "Southwest",
    "Plovdiv": "South",
    "Varna": "Northeast",
    "Burgas": "Southeast",
    "Pleven": "North",
}

COASTAL_CITIES: list[str] = ["Varna", "Burgas"]

# Seasons by calendar month.
SEASON_MONTHS: list[tuple[str, list[int]]] = [
    ("Winter", [12, 1, 2]),
    ("Spring", [3, 4, 5]),
    ("Summer", [6, 7, 8]),
    ("Autumn", [9, 10, 11]),
]

# Display order of seasons in the hour x season price matrix.
SEASON_ORDER: list[str] = ["Winter", "Spring", "Summer", "Autumn"]

# Radiation category: first matching rule wins, else "Very High".
#   = 0 -> None, < 100 -> Low, < 400 -> Medium, < 700 -> High
RADIATION_NONE_AT = 0.0
RADIATION_LADDER: list[tuple[float, str]] = [(100.0, "Low"), (400.0, "Medium"), (700.0, "High")]

# Price category: first matching rule wins, else "Very High".
#   < 0 -> Negative, < 50 -> Low, < 100 -> Medium, < 200 -> High
PRICE_LADDER: list[tuple[float, str]] = [(0.0, "Negative"), (50.0, "Low"), (100.0, "Medium"), (200.0, "High")]

# Business hours: 06:00 to 21:00 inclusive, on every day of the week.
BUSINESS_HOUR_FIRST = 6
BUSINESS_HOUR_LAST = 21

# Weekday numbering used by all tables: 0 = Sunday ... 6 = Saturday.
WEEKEND_DAYS: list[int] = [0, 6]

MONTH_NAMES: list[str] = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]
DAY_NAMES: list[str] = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]

# Constant attributes of the market feeds.
MARKET_COUNTRY = "Bulgaria"
MARKET_CURRENCY = "EUR"
MARKET_UNIT = "MWh"
MARKET_TIME_ZONE = "Europe/Sofia"

# ---------------------------------------------------------------------------
# Declared schemas of the raw zone (checked at read, never inferred)
# ---------------------------------------------------------------------------

RAW_WEATHER = T.StructType([
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("shortwave_radiation_wm2", T.DoubleType()),
    T.StructField("windspeed_10m_kmh", T.DoubleType()),
    T.StructField("temperature_2m_c", T.DoubleType()),
    T.StructField("city", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
])

RAW_PRICES = T.StructType([
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("price_eur_mwh", T.DoubleType()),
    T.StructField("country", T.StringType()),
    T.StructField("currency", T.StringType()),
    T.StructField("unit", T.StringType()),
])

RAW_GENERATION = T.StructType(
    [T.StructField("timestamp", T.TimestampNTZType())]
    + [T.StructField(src, T.DoubleType()) for src, _ in GENERATION_SOURCES]
    + [T.StructField("country", T.StringType())]
)

RAW_SCHEMAS: dict[str, T.StructType] = {
    "raw_weather": RAW_WEATHER,
    "raw_prices": RAW_PRICES,
    "raw_generation": RAW_GENERATION,
}

# Landed weather response: one JSON object of parallel hourly arrays.
WEATHER_LANDING = T.StructType([
    T.StructField("city", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("hourly", T.StructType([
        T.StructField("time", T.ArrayType(T.StringType())),
        T.StructField("shortwave_radiation", T.ArrayType(T.DoubleType())),
        T.StructField("windspeed_10m", T.ArrayType(T.DoubleType())),
        T.StructField("temperature_2m", T.ArrayType(T.DoubleType())),
    ])),
])

# Table zones of the warehouse layout.
RAW_TABLES = ["raw_weather", "raw_prices", "raw_generation"]
CLEANED_TABLES = ["cleaned_weather", "cleaned_prices", "cleaned_generation"]
STAR_TABLES = ["dim_date", "dim_city", "fct_weather_hourly", "fct_prices_hourly", "fct_generation_hourly"]
ALL_TABLES = RAW_TABLES + CLEANED_TABLES + STAR_TABLES

ZONE_OF = {**{t: "raw" for t in RAW_TABLES},
           **{t: "cleaned" for t in CLEANED_TABLES},
           **{t: "curated" for t in STAR_TABLES}}
