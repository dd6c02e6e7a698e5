"""Daily refresh: file stream -> idempotent per-partition merge."""

import json
import os
import time

from hourmart.streaming.refresh import load_weather_files, start_weather_refresh


def _land(folder, name, city, day, values):
    os.makedirs(folder, exist_ok=True)
    doc = {"city": city, "hourly": {"time": [f"{day}T{h:02d}:00" for h in range(len(values))],
                                    "shortwave_radiation": values, "windspeed_10m": [1.0] * len(values),
                                    "temperature_2m": [2.0] * len(values)}}
    with open(os.path.join(folder, name), "w") as f:
        json.dump(doc, f)


def test_daily_load_twice_equals_once(spark, scratch):
    land = os.path.join(scratch, "landing")
    table = os.path.join(scratch, "raw_weather")
    _land(land, "sofia-0101.json", "Sofia", "2024-01-01", [float(h) for h in range(24)])
    _land(land, "varna-0101.json", "Varna", "2024-01-01", [1.0] * 24)
    load_weather_files(spark, land, table)
    once = sorted(map(tuple, spark.read.parquet(table).collect()), key=repr)
    load_weather_files(spark, land, table)
    twice = sorted(map(tuple, spark.read.parquet(table).collect()), key=repr)
    assert once == twice and len(once) == 48


def test_stream_refresh_merges_new_days_and_corrections(spark, scratch):
    land = os.path.join(scratch, "landing")
    table = os.path.join(scratch, "raw_weather")
    ckpt = os.path.join(scratch, "ckpt")
    _land(land, "sofia-0101.json", "Sofia", "2024-01-01", [1.0] * 24)
    q = start_weather_refresh(spark, land, table, ckpt)
    q.awaitTermination(120)
    assert spark.read.parquet(table).count() == 24

    time.sleep(1.1)  # a later file modification time
    _land(land, "sofia-0101-fix.json", "Sofia", "2024-01-01", [5.0] * 12)   # corrects the first 12 hours
    _land(land, "sofia-0102.json", "Sofia", "2024-01-02", [2.0] * 24)       # a new day
    q = start_weather_refresh(spark, land, table, ckpt)
    q.awaitTermination(120)
    df = spark.read.parquet(table)
    assert df.count() == 48
    day1 = {r.timestamp.hour: r.shortwave_radiation_wm2 for r in df.where("p_date = '2024-01-01'").collect()}
    assert all(day1[h] == 5.0 for h in range(12)) and all(day1[h] == 1.0 for h in range(12, 24))
    assert df.where("p_date = '2024-01-02'").count() == 24


def test_shared_dir_fallback_only_when_unset(scratch):
    import subprocess
    import sys

    empty_conf = os.path.join(scratch, "conf")
    os.makedirs(empty_conf)
    code = (
        "import sys; sys.path.insert(0, %r)\n"
        "from hourmart.session import get_session, shared_dir\n"
        "s = get_session('local[1]')\n"
        "print('DIR', shared_dir(s, %r))\n"
        "print('ROWS', s.range(5).checkpoint(eager=True).count())\n"
    ) % (os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.join(scratch, "ckpt"))
    env = dict(os.environ, SPARK_CONF_DIR=empty_conf)
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=300).stdout
    assert f"DIR {os.path.join(scratch, 'ckpt')}" in out and "ROWS 5" in out


def _lines(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(json.dumps(r) for r in rows))


def test_price_and_generation_refresh_keep_both_autumn_hours(spark, scratch):
    from datetime import datetime

    from hourmart.sources.catalog import LayeredTables
    from hourmart.streaming.refresh import load_generation_files, load_price_files

    land_p, land_g = os.path.join(scratch, "lp"), os.path.join(scratch, "lg")
    tp, tg = os.path.join(scratch, "raw_prices"), os.path.join(scratch, "raw_generation")
    _lines(land_p, "day1.json", [{"timestamp_utc": "2024-10-27T00:00:00Z", "price": 10.0},
                                 {"timestamp_utc": "2024-10-27T01:00:00Z", "price": 11.0},
                                 {"timestamp_utc": "2024-10-27T02:00:00+00:00", "price": 12.0}])
    _lines(land_g, "day1.json", [{"timestamp_utc": "2024-10-27T00:00:00Z", "source": "Solar", "mw": 1.0},
                                 {"timestamp_utc": "2024-10-27T00:00:00Z", "source": "Nuclear", "mw": 2.0},
                                 {"timestamp_utc": "2024-10-27T01:00:00Z", "source": "Solar", "mw": 3.0}])
    assert load_price_files(spark, land_p, tp) == 3
    assert load_price_files(spark, land_p, tp) == 3  # replay: same table
    assert load_generation_files(spark, land_g, tg) == 2
    prices = spark.read.parquet(tp)
    assert sorted(r.timestamp for r in prices.collect()) == [datetime(2024, 10, 27, 3), datetime(2024, 10, 27, 3),
                                                              datetime(2024, 10, 27, 4)]
    time.sleep(1.1)
    _lines(land_p, "fix.json", [{"timestamp_utc": "2024-10-27T01:00:00Z", "price": 99.0}])
    assert load_price_files(spark, land_p, tp) == 3
    assert {r.price_eur_mwh for r in spark.read.parquet(tp).collect()} == {10.0, 99.0, 12.0}
    # the refreshed raw tables feed the cleaned and star builders unchanged
    t = LayeredTables(spark, {"raw_prices": spark.read.parquet(tp), "raw_generation": spark.read.parquet(tg)})
    assert t.table("fct_prices_hourly").count() == 3
    g = {r.total_generation_mw for r in t.table("fct_generation_hourly").collect()}
    assert g == {3.0}


def test_price_stream_refresh(spark, scratch):
    from hourmart.streaming.refresh import start_refresh

    land, table, ckpt = (os.path.join(scratch, x) for x in ("lp", "raw_prices", "ckpt"))
    _lines(land, "d1.json", [{"timestamp_utc": f"2024-03-30T{h:02d}:00:00Z", "price": float(h)} for h in range(24)])
    start_refresh(spark, "prices", land, table, ckpt).awaitTermination(120)
    assert spark.read.parquet(table).count() == 24
    _lines(land, "d2.json", [{"timestamp_utc": f"2024-03-31T{h:02d}:00:00Z", "price": 1.0} for h in range(24)])
    start_refresh(spark, "prices", land, table, ckpt).awaitTermination(120)
    df = spark.read.parquet(table)
    assert df.count() == 48 and df.select("timestamp").distinct().count() == 48  # spring gap: no collision
