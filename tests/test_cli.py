"""Command line: build from the driver tables, query the stored warehouse."""

import os

from hourmart.__main__ import main

from conftest import SF_SMALL


def test_cli_build_and_query(spark, scratch, capsys):
    wh = os.path.join(scratch, "wh")
    assert main(["build", "--driver-tables", SF_SMALL, "--warehouse", wh]) == 0
    assert '"fct_prices_hourly"' in capsys.readouterr().out
    out = os.path.join(scratch, "kpis")
    assert main(["query", "agg_15_city_weather_kpis", "--warehouse", wh, "--city", "Varna", "--out", out]) == 0
    assert spark.read.parquet(out).count() == 1
    assert main(["list"]) == 0
    assert "agg_06_seasonal_flagship" in capsys.readouterr().out


def test_cli_refresh_prices(spark, scratch, capsys):
    import json

    land = os.path.join(scratch, "landing")
    os.makedirs(land)
    with open(os.path.join(land, "d.json"), "w") as f:
        f.write("\n".join(json.dumps({"timestamp_utc": f"2024-05-01T{h:02d}:00:00Z", "price": 50.0 + h})
                          for h in range(24)))
    table = os.path.join(scratch, "raw_prices")
    assert main(["refresh", "--feed", "prices", "--landing", land, "--table", table]) == 0
    assert capsys.readouterr().out.strip().endswith("24")
    assert spark.read.parquet(table).count() == 24
