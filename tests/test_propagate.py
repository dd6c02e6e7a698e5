"""Cleaned and star tables follow a refresh, period by period."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from hourmart import schemas as S
from hourmart.sinks.writer import DuplicateKeyError, build_warehouse
from hourmart.sources.catalog import LayeredTables, StoredTables
from hourmart.streaming.propagate import in_periods, key_range, refresh_dependants, touched_rows
from hourmart.streaming.refresh import WEATHER_KEYS, merge_touched

from test_plans import plan_text
from test_streaming import _land

WEATHER = "timestamp string, city string, shortwave_radiation_wm2 double, latitude double, longitude double"


def _weather(spark, rows):
    df = spark.createDataFrame(rows, WEATHER).withColumns(
        {"windspeed_10m_kmh": F.lit(3.0), "temperature_2m_c": F.lit(9.0), "timestamp": F.col("timestamp").cast("timestamp_ntz")})
    return df.select(*[f.name for f in S.RAW_WEATHER.fields])


def _hours(city, days, value=5.0, at=(1.0, 2.0)):
    return [(f"{d} {h:02d}:00:00", city, value, *at) for d in days for h in (0, 7, 13)]


def _empty(spark, name):
    return spark.createDataFrame([], S.RAW_SCHEMAS[name])


def _build(spark, base, weather, period="month"):
    build_warehouse(spark, LayeredTables(spark, {"raw_weather": weather, "raw_prices": _empty(spark, "raw_prices"),
                                                 "raw_generation": _empty(spark, "raw_generation")}), base, period=period)
    return StoredTables(spark, base)


def _contents(t, names=("cleaned_weather", "dim_date", "dim_city", "fct_weather_hourly")):
    return {n: sorted(map(str, t.table(n).collect())) for n in names}


def _files(base, table):
    return {os.path.relpath(f, base): os.stat(f).st_mtime_ns for f in glob.glob(f"{base}/*/{table}/**/*.parquet", recursive=True)}


@pytest.fixture
def first(spark):
    return _weather(spark, _hours("Sofia", ["2024-01-30", "2024-02-01"]) + _hours("Varna", ["2024-01-30", "2024-03-05"]))


@pytest.mark.parametrize("period", ["year", "date"])
def test_followed_tables_equal_a_full_build(spark, scratch, first, period):
    more = _weather(spark, _hours("Sofia", ["2024-02-01", "2024-02-02"], 50.0) + _hours("Varna", ["2024-04-01"], 7.0))
    t = _build(spark, f"{scratch}/a", first, period)
    for _ in range(2):  # a replayed batch changes nothing
        _, touched, by = merge_touched(more.withColumn("_landed_at", F.lit(9)), t.path("raw_weather"), "raw_weather", WEATHER_KEYS)
        assert by == period
        refresh_dependants(spark, t.base, "raw_weather", touched, by)
        whole = first.join(more, ["timestamp", "city"], "left_anti").unionByName(more)
        assert _contents(t) == _contents(_build(spark, f"{scratch}/b", whole, period))


def test_only_touched_periods_are_read_and_written(spark, scratch, first):
    t = _build(spark, f"{scratch}/a", first)
    before = {n: _files(t.base, n) for n in ("cleaned_weather", "fct_weather_hourly", "dim_city")}
    more = _weather(spark, _hours("Varna", ["2024-02-03"]))
    _, touched, by = merge_touched(more.withColumn("_landed_at", F.lit(9)), t.path("raw_weather"), "raw_weather", WEATHER_KEYS)
    assert touched == [202402]
    written = refresh_dependants(spark, t.base, "raw_weather", touched, by)
    assert written == {"cleaned_weather": 6, "dim_date": 3, "fct_weather_hourly": 6}
    for n, files in before.items():
        now = _files(t.base, n)
        assert {f for f in set(now) ^ set(files) | {f for f in now if now[f] != files.get(f)} if "p_month=202402" not in f} == set()
    rows = touched_rows(spark, t, "cleaned_weather", touched, by, t.table("cleaned_weather").schema)
    assert all("p_month=202402" in f for f in rows.inputFiles())
    known = t.table("dim_date").where(in_periods(F.col("date_key"), touched, by))
    assert "GreaterThanOrEqual(date_key,2024020000), LessThanOrEqual(date_key,2024029999)" in plan_text(known)


def test_new_stations_are_renumbered_or_appended(spark, scratch, first):
    more = _weather(spark, _hours("Pleven", ["2024-02-01"], 8.0, (3.0, 4.0)) + _hours("Zora", ["2024-02-01"], 8.0, (None, 4.0)))
    t = _build(spark, f"{scratch}/a", first)
    _, touched, by = merge_touched(more.withColumn("_landed_at", F.lit(9)), t.path("raw_weather"), "raw_weather", WEATHER_KEYS)
    refresh_dependants(spark, t.base, "raw_weather", touched, by)
    assert _contents(t) == _contents(_build(spark, f"{scratch}/b", first.unionByName(more)))
    assert {r.city: r.city_key for r in t.table("dim_city").collect()} == {"Pleven": 1, "Sofia": 2, "Varna": 3, "Zora": 4}

    u = _build(spark, f"{scratch}/c", first)
    march = {f for f in _files(u.base, "fct_weather_hourly") if "p_month=202403" in f}
    for _ in range(2):
        _, touched, by = merge_touched(more.withColumn("_landed_at", F.lit(9)), u.path("raw_weather"), "raw_weather", WEATHER_KEYS)
        refresh_dependants(spark, u.base, "raw_weather", touched, by, new_stations="append")
    assert {r.city: r.city_key for r in u.table("dim_city").collect()} == {"Sofia": 1, "Varna": 2, "Pleven": 3, "Zora": 4}
    assert march == {f for f in _files(u.base, "fct_weather_hourly") if "p_month=202403" in f}  # no key moved

    def named(t):
        f = t.table("fct_weather_hourly").join(t.table("dim_city"), "city_key").drop("city_key")
        return sorted(map(str, f.collect()))
    assert named(u) == named(t)
    with pytest.raises(ValueError):
        refresh_dependants(spark, u.base, "raw_weather", touched, by, new_stations="other")


def test_two_times_in_one_hour_are_refused(spark, scratch, first):
    t = _build(spark, f"{scratch}/a", first)
    half = _weather(spark, [("2024-02-01 07:30:00", "Sofia", 1.0, 1.0, 2.0)])
    _, touched, by = merge_touched(half.withColumn("_landed_at", F.lit(9)), t.path("raw_weather"), "raw_weather", WEATHER_KEYS)
    with pytest.raises(DuplicateKeyError):
        refresh_dependants(spark, t.base, "raw_weather", touched, by)


def test_rows_without_time_touch_nothing_below(spark, scratch, first):
    t = _build(spark, f"{scratch}/a", first)
    before = _contents(t)
    assert refresh_dependants(spark, t.base, "raw_weather", [None], "month") == {}
    assert _contents(t) == before
    assert key_range("2024-02-03", "date") == (2024020300, 2024020399) and key_range(2024, "year") == (2024000000, 2024999999)


def test_cli_refreshes_a_warehouse(spark, scratch, first):
    from hourmart.__main__ import main

    t = _build(spark, f"{scratch}/a", first)
    _land(f"{scratch}/land", "x.json", "Ruse", "2024-03-06", [1.0, 2.0])
    assert main(["refresh", "--landing", f"{scratch}/land", "--warehouse", t.base]) == 0
    assert t.table("fct_weather_hourly").where("date_key between 2024030600 and 2024030623").count() == 2
    assert t.table("dim_city").count() == 3


def test_only_heavy_cities_are_salted(spark, stored_rows=200):
    from hourmart.operators import star

    rows = _weather(spark, [(f"2024-01-01 {h % 24:02d}:00:00", f"S{h}", 1.0, 1.0, 2.0) for h in range(stored_rows)])
    clean = rows.withColumns({"is_daytime": F.lit(True), "radiation_category": F.lit("Low")})
    dim = star.dim_city(clean)
    assert star.heavy_cities(clean) == []
    assert "_salt" not in plan_text(star.fct_weather_hourly(clean, dim))  # dimension rows unchanged
    hot = clean.unionByName(clean.where("city = 'S7'").withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(100)))).drop("n"))
    assert star.heavy_cities(hot) == ["S7"]
    fact = star.fct_weather_hourly(hot, dim)
    assert "_salt" in plan_text(fact) and fact.count() == stored_rows + 100
