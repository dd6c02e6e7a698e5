"""Landed files -> raw rows: JSON responses, UTC feeds, long/wide, nanoseconds."""

import json
import os
from datetime import datetime

import pandas as pd
from pyspark.sql import functions as F

from hourmart import schemas as S
from hourmart.sources import landing as L


def _write_response(folder, name, city, times, rad, wind, temp, with_coords=False):
    doc = {"city": city, "hourly": {"time": times, "shortwave_radiation": rad,
                                    "windspeed_10m": wind, "temperature_2m": temp}}
    if with_coords:
        doc.update({"latitude": 1.5, "longitude": 2.5})
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        json.dump(doc, f, indent=2)  # multi-line, as an API response lands


def test_weather_landing_parallel_arrays(spark, scratch):
    land = os.path.join(scratch, "landing")
    _write_response(land, "sofia.json", "Sofia", ["2024-01-01T00:00", "2024-01-01T01:00", "2024-01-01T02:00"],
                    [0.0, None, 5.0], [3.1, 3.2, 3.3], [-1.0, -1.5, -2.0])
    _write_response(land, "ruse.json", "Ruse", ["2024-01-01T00:00"], [1.0], [1.0], [1.0], with_coords=True)
    rows = L.read_weather_landing(spark, land).orderBy("city", "timestamp").collect()
    assert len(rows) == 4
    ruse = rows[0]
    assert (ruse.city, ruse.latitude, ruse.longitude) == ("Ruse", 1.5, 2.5)
    sofia = rows[1:]
    assert [r.timestamp for r in sofia] == [datetime(2024, 1, 1, h) for h in range(3)]
    assert [r.shortwave_radiation_wm2 for r in sofia] == [0.0, None, 5.0]  # NULL element stays NULL
    assert (sofia[0].latitude, sofia[0].longitude) == (42.7065, 23.3219)  # filled from the station list
    assert [f.name for f in L.read_weather_landing(spark, land).schema.fields] == [f.name for f in S.RAW_WEATHER]


def test_landing_docs_roundtrip(spark):
    raw = spark.createDataFrame(
        [(datetime(2024, 3, 31, h), float(h), 1.0, 2.0, "Varna", 43.2141, 27.9147) for h in range(24)]
        + [(datetime(2024, 4, 1, 0), None, None, None, "Varna", 43.2141, 27.9147)], S.RAW_WEATHER)
    docs = L.weather_landing_docs(raw)
    assert docs.count() == 2  # one document per city and day
    back = L.weather_rows(L.from_json_lines(L.to_json_lines(docs)))
    assert back.exceptAll(raw).count() == 0 and raw.exceptAll(back).count() == 0


def test_prices_from_utc_keep_autumn_repeat(spark):
    s = spark.createDataFrame([(datetime(2024, 10, 27, 0), 10.0), (datetime(2024, 10, 27, 1), 11.0)],
                              "timestamp_utc timestamp_ntz, price double")
    rows = L.prices_from_utc(s).collect()
    assert [r.timestamp for r in rows] == [datetime(2024, 10, 27, 3)] * 2
    assert (rows[0].country, rows[0].currency, rows[0].unit) == ("Bulgaria", "EUR", "MWh")


def test_generation_long_wide_roundtrip(spark):
    src = [s for s, _ in S.GENERATION_SOURCES]
    rows = [(datetime(2024, 1, 1, 0), *[float(i) if i % 3 else None for i in range(11)], "Bulgaria")]
    wide = spark.createDataFrame(rows, S.RAW_GENERATION)
    long = L.generation_long(wide)
    assert long.count() == sum(1 for i in range(11) if i % 3)
    back = L.generation_wide(long)
    assert back.columns == wide.columns
    assert back.exceptAll(wide).count() == 0
    assert src[0] in back.columns


def test_flatten_headers_and_numeric_columns(spark):
    from hourmart.functions.stats import numeric_columns

    df = spark.createDataFrame([((1.0, 2.0), "x", 3)], "Solar struct<`Actual Aggregated`: double, "
                                                      "`Actual Consumption`: double>, country string, n int")
    flat = L.flatten_headers(df)
    assert flat.columns == ["Solar_Actual Aggregated", "Solar_Actual Consumption", "country", "n"]
    assert numeric_columns(flat) == ["Solar_Actual Aggregated", "Solar_Actual Consumption", "n"]


def test_nanosecond_parquet(spark, scratch):
    import pyarrow as pa
    import pyarrow.parquet as pq

    ts = pd.to_datetime(["2024-01-01 00:00:00.000000000", "2024-10-27 03:00:00.123456789"], format="ISO8601")
    table = pa.table({"timestamp": pa.array(ts, type=pa.timestamp("ns")), "v": [1.0, 2.0]})
    path = os.path.join(scratch, "nanos.parquet")
    pq.write_table(table, path, version="2.6")
    old = spark.conf.get("spark.sql.legacy.parquet.nanosAsLong", "false")
    try:
        got = [r.timestamp for r in L.read_parquet_nanos(spark, path, ["timestamp"]).orderBy("v").collect()]
    finally:
        spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", old)
    assert got == [datetime(2024, 1, 1), datetime(2024, 10, 27, 3, 0, 0, 123456)]


def test_check_raw_schema_names_missing_columns(spark):
    import pytest

    df = spark.createDataFrame([(datetime(2024, 1, 1), 1.0)], "timestamp timestamp_ntz, price_eur_mwh double")
    with pytest.raises(ValueError, match="country"):
        L.check_raw_schema(df, "raw_prices")
    ok = L.check_raw_schema(df.withColumn("country", F.lit("Bulgaria")).withColumn("currency", F.lit("EUR"))
                            .withColumn("unit", F.lit("MWh")), "raw_prices")
    assert ok.schema == S.RAW_PRICES or [f.name for f in ok.schema] == [f.name for f in S.RAW_PRICES]


def test_dedupe_latest(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 3), (2, "c", 2), (1, "d", 2)], "k int, v string, o int")
    got = {r.k: r.v for r in L.dedupe_latest(df, ["k"], "o").collect()}
    assert got == {1: "b", 2: "c"}


def test_restrict_range_inclusive_end(spark):
    df = spark.createDataFrame([(datetime(2023, 12, 31, 23),), (datetime(2024, 1, 1, 0),),
                                (datetime(2024, 12, 31, 0),), (datetime(2024, 12, 31, 1),)], "timestamp timestamp_ntz")
    got = [r.timestamp for r in L.restrict_range(df, "2024-01-01", "2024-12-31 00:00:00").collect()]
    assert got == [datetime(2024, 1, 1, 0), datetime(2024, 12, 31, 0)]


def test_single_variable_response(spark, scratch):
    land = os.path.join(scratch, "landing")
    os.makedirs(land)
    with open(os.path.join(land, "sofia.json"), "w") as f:
        json.dump({"city": "Sofia", "hourly": {"time": ["2024-01-01T11:00", "2024-01-01T12:00"],
                                               "shortwave_radiation": [120.0, 180.0]}}, f)
    rows = L.read_weather_landing(spark, land).orderBy("timestamp").collect()
    assert [(r.shortwave_radiation_wm2, r.windspeed_10m_kmh, r.temperature_2m_c) for r in rows] == \
        [(120.0, None, None), (180.0, None, None)]
