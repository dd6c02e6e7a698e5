"""The refresh loses nothing: sources per hour, landing order, NULL times, stored period, JSON layouts, offsets."""

import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from hourmart import schemas as S
from hourmart.functions import stats
from hourmart.sinks.writer import write_table
from hourmart.sources import landing as L
from hourmart.streaming import refresh as R


def _land(folder, name, text, when):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write(text)
    os.utime(path, (when, when))


def _doc(city, day, values):
    return {"city": city, "hourly": {"time": [f"{day}T{h:02d}:00" for h in range(len(values))],
                                     "shortwave_radiation": values}}


def test_sources_of_one_hour_from_several_files(spark, scratch):
    table = os.path.join(scratch, "gen")
    for i, source in enumerate(("Solar", "Nuclear")):
        land = os.path.join(scratch, f"land{i}")
        _land(land, "a.json", json.dumps({"timestamp_utc": "2024-01-01T10:00:00Z", "source": source, "mw": 10.0 + i}), 1000 + i)
        R.load_generation_files(spark, land, table)
    row = spark.read.parquet(table).collect()
    assert len(row) == 1 and (row[0]["Solar"], row[0]["Nuclear"]) == (10.0, 11.0)


def test_later_landed_file_wins_in_any_load_order(spark, scratch):
    table, new, old = (os.path.join(scratch, n) for n in ("t", "new", "old"))
    _land(new, "n.json", json.dumps(_doc("Sofia", "2024-01-01", [5.0])), 2_000_000)
    _land(old, "o.json", json.dumps(_doc("Sofia", "2024-01-01", [9.0])), 1_000_000)
    R.load_weather_files(spark, new, table)
    R.load_weather_files(spark, old, table)
    assert [r.shortwave_radiation_wm2 for r in spark.read.parquet(table).collect()] == [5.0]


def test_rows_without_a_time_stay(spark, scratch):
    table = os.path.join(scratch, "t")
    for i in range(2):
        land = os.path.join(scratch, f"l{i}")
        doc = {"city": "Sofia", "hourly": {"time": [None], "shortwave_radiation": [float(i)]}}
        _land(land, "a.json", json.dumps(doc), 1000 + i)
        R.load_weather_files(spark, land, table)
    assert spark.read.parquet(table).count() == 2


def test_refresh_takes_the_stored_period(spark, scratch):
    table, land = os.path.join(scratch, "t"), os.path.join(scratch, "l")
    rows = [(datetime(2024, 1, 1, 0), 1.0, 1.0, 1.0, "Sofia", 42.7065, 23.3219)]
    write_table(spark.createDataFrame(rows, S.RAW_WEATHER), table, "raw_weather", period="year")
    _land(land, "a.json", json.dumps(_doc("Sofia", "2024-01-02", [2.0])), 1000)
    R.load_weather_files(spark, land, table)
    assert spark.read.parquet(table).count() == 2
    with pytest.raises(ValueError):
        R.load_weather_files(spark, land, table, period="date")


def test_json_lines_and_trailing_content(spark, scratch):
    lines, bad = os.path.join(scratch, "lines"), os.path.join(scratch, "bad")
    _land(lines, "a.json", "\n".join(json.dumps(_doc(c, "2024-01-01", [1.0])) for c in ("Sofia", "Varna", "Pleven")), 1)
    assert L.read_weather_landing(spark, lines).count() == 3
    _land(bad, "b.json", json.dumps(_doc("Sofia", "2024-01-01", [1.0]), indent=1) + "\n{", 1)
    with pytest.raises(Exception, match="neither one JSON document"):
        L.read_weather_landing(spark, bad).collect()


def test_offsets_and_seconds(spark):
    rows = spark.createDataFrame([(s,) for s in ("2024-01-01T00:00:00+02:00", "2024-07-01T00:00:00+0300",
                                                 "2024-01-01T10:00:00Z", "2024-01-01T10:00:00")], "s string")
    assert [r[0] for r in rows.select(L.parse_utc_instant(F.col("s"))).collect()] == [
        datetime(2023, 12, 31, 22), datetime(2024, 6, 30, 21), datetime(2024, 1, 1, 10), datetime(2024, 1, 1, 10)]
    local = spark.createDataFrame([("2024-01-01T01:00",), ("2024-01-01T01:00:00",)], "s string")
    assert {r[0] for r in local.select(L.parse_landing_time(F.col("s"))).collect()} == {datetime(2024, 1, 1, 1)}


def test_pandas_written_nanosecond_file_and_missing_column(spark, scratch):
    import pandas as pd

    path = os.path.join(scratch, "p.parquet")
    frame = pd.DataFrame({"timestamp": pd.to_datetime(["2024-01-01 00:00:00.000001"]).astype("datetime64[ns]"),
                          "price_eur_mwh": [1.0], "country": ["x"], "currency": ["y"], "unit": ["z"]})
    frame.to_parquet(path, version="2.6")
    assert L.read_raw_parquet(spark, path, "raw_prices").first()["timestamp"] == datetime(2024, 1, 1, 0, 0, 0, 1)
    frame.drop(columns="price_eur_mwh").to_parquet(path, version="2.6")
    with pytest.raises(ValueError, match="price_eur_mwh"):
        L.read_raw_parquet(spark, path, "raw_prices")


def test_nan_is_missing_everywhere(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (None,)], "v double")
    d = stats.describe(df, "v").first()
    assert (d["count"], d["mean"], d["p50"], d["max"]) == (2, 1.5, 1.5, 2.0)
    assert stats.null_counts(df).first()["null_count"] == 2


def test_hour_without_any_source_stays(spark):
    row = (datetime(2024, 1, 1, 0), *[None] * len(S.GENERATION_SOURCES), "Bulgaria")
    wide = spark.createDataFrame([row], S.RAW_GENERATION)
    assert L.generation_wide(L.generation_long(wide)).collect() == wide.collect()


def test_a_merge_evaluates_its_new_rows_once(spark, scratch):
    rows = [(datetime(2024, 1, 1, h % 3), "Sofia" if h < 6 else None, float(h)) for h in range(9)]
    seen = spark.sparkContext.accumulator(0)

    def passed(v):
        seen.add(1)
        return v

    count = F.udf(passed, "double").asNondeterministic()
    new = spark.createDataFrame(rows, "timestamp timestamp_ntz, city string, temperature_2m_c double") \
        .withColumn("temperature_2m_c", count("temperature_2m_c")).withColumn("_landed_at", F.lit(1))
    assert R.merge_into_partitions(new, f"{scratch}/t", "raw_weather", R.WEATHER_KEYS) == 6
    assert seen.value == len(rows)
    # loaded again: the same rows, those without a city told apart by all columns
    assert R.merge_into_partitions(new, f"{scratch}/t", "raw_weather", R.WEATHER_KEYS) == 6
    got = spark.read.parquet(f"{scratch}/t").collect()
    assert sorted((r.city or "", r.temperature_2m_c) for r in got) == [("", 6.0), ("", 7.0), ("", 8.0),
                                                                       ("Sofia", 3.0), ("Sofia", 4.0), ("Sofia", 5.0)]


def _counted_rows(spark, seen, rows, table, column):
    """Rows of a raw table that count into ``seen`` whenever they are evaluated."""
    def passed(v):
        seen.add(1)
        return v

    names = [f.name for f in S.RAW_SCHEMAS[table].fields]
    full = [tuple(r.get(n) for n in names) for r in rows]
    return spark.createDataFrame(full, S.RAW_SCHEMAS[table]).withColumn(column, F.udf(passed, "double").asNondeterministic()(column))


def _weather_of(times):
    return [{"timestamp": t, "city": c, "temperature_2m_c": float(i), "latitude": 1.0, "longitude": 2.0}
            for i, t in enumerate(times) for c in ("Sofia", "Varna")]


def test_a_merge_reads_what_it_replaces_without_a_copy(spark, scratch, monkeypatch):
    def merged(rows, landed):
        new = spark.createDataFrame(rows, "timestamp timestamp_ntz, city string, temperature_2m_c double")
        return R.merge_into_partitions(new.withColumn("_landed_at", F.lit(landed)), f"{scratch}/t", "raw_weather",
                                       R.WEATHER_KEYS, "year")

    def refused(*args, **kwargs):
        raise AssertionError("a merge needs no checkpoint")

    monkeypatch.setattr(type(spark.range(1)), "checkpoint", refused)
    first = [(datetime(2024, 1, 1, h), "Sofia", float(h)) for h in range(20)] + [(datetime(2023, 1, 1), "Sofia", 1.0)]
    assert merged(first, 1) == 21
    assert merged([(datetime(2024, 1, 1, 3), "Sofia", 90.0), (datetime(2024, 1, 1, 3), "Varna", 91.0)], 2) == 21
    assert merged([(datetime(2024, 1, 1, 3), "Sofia", -1.0)], 0) == 21
    got = {(r.timestamp, r.city): r.temperature_2m_c for r in spark.read.parquet(f"{scratch}/t").collect()}
    want = {(t, c): v for t, c, v in first} | {(datetime(2024, 1, 1, 3), "Sofia"): 90.0, (datetime(2024, 1, 1, 3), "Varna"): 91.0}
    assert got == want


def test_star_after_refresh_derives_each_raw_table_once(spark):
    from hourmart.plans.storage import star_after_refresh
    from hourmart.sources.catalog import LayeredTables

    times = [datetime(y, 1, d, h) for y in (2022, 2023, 2024) for d in (1, 2) for h in (0, 11, 12, 23)]
    rows = {"raw_weather": (_weather_of(times), "temperature_2m_c"),
            "raw_prices": ([{"timestamp": t, "price_eur_mwh": 7.0, "country": "Bulgaria"} for t in times], "price_eur_mwh"),
            "raw_generation": ([{"timestamp": t, "Solar": 5.0, "country": "Bulgaria"} for t in times], "Solar")}
    seen = {n: spark.sparkContext.accumulator(0) for n in rows}
    t = LayeredTables(spark, {n: _counted_rows(spark, seen[n], r, n, c) for n, (r, c) in rows.items()})
    wide = star_after_refresh(t).collect()
    assert {n: a.value for n, a in seen.items()} == {n: len(r) for n, (r, _) in rows.items()}
    assert len(wide) == len(rows["raw_weather"][0])
    assert all(r.price_eur_mwh == 7.0 and r.total_generation_mw == 5.0 for r in wide)


def test_refresh_out_of_order_derives_and_groups_its_rows_once(spark, monkeypatch):
    from hourmart.plans.storage import refresh_out_of_order
    from hourmart.sources.catalog import LayeredTables

    rows = _weather_of([datetime(2024, 1, d, h) for d in (1, 2, 3) for h in (0, 11, 12, 23)] + [datetime(2024, 1, 4, 5)])
    seen, loads, load = spark.sparkContext.accumulator(0), [], R.load_weather_files

    def kept(spark, landing_path, *args, **kwargs):
        loads.append(L.read_weather_landing(spark, landing_path))
        return load(spark, landing_path, *args, **kwargs)

    monkeypatch.setattr(R, "load_weather_files", kept)
    got = refresh_out_of_order(LayeredTables(spark, {"raw_weather": _counted_rows(spark, seen, rows, "raw_weather", "temperature_2m_c")}))
    assert seen.value == len(rows)
    later, whole = ({(r.timestamp, r.city) for r in d.collect()} for d in loads)
    assert whole == {(r["timestamp"], r["city"]) for r in rows}
    assert later == {(t, c) for t, c in whole if t.hour >= 12}
    assert sorted((r.timestamp, r.city, r.temperature_2m_c) for r in got.collect()) == sorted(
        (r["timestamp"], r["city"], r["temperature_2m_c"]) for r in rows)
