"""Built tables and queries on hand-made raw rows: degenerate and edge inputs."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from hourmart import schemas as S
from hourmart.plans import correlations as COR
from hourmart.plans import mix as MIX
from hourmart.plans import prices as PR
from hourmart.plans import registry as REG
from hourmart.sources.catalog import LayeredTables

SRC = [s for s, _ in S.GENERATION_SOURCES]


def _gen_row(ts, **vals):
    return (ts, *[vals.get(s) for s in SRC], "Bulgaria")


def _tables(spark, weather=(), prices=(), generation=()):
    return LayeredTables(spark, {
        "raw_weather": spark.createDataFrame(list(weather), S.RAW_WEATHER),
        "raw_prices": spark.createDataFrame(list(prices), S.RAW_PRICES),
        "raw_generation": spark.createDataFrame(list(generation), S.RAW_GENERATION),
    })


def test_generation_totals_and_renewable_pct(spark):
    t0 = datetime(2024, 1, 1, 0)
    rows = [
        _gen_row(datetime(2024, 1, 1, 0)),                                            # all NULL
        _gen_row(datetime(2024, 1, 1, 1), Nuclear=0.0, Solar=0.0),                    # total 0
        _gen_row(datetime(2024, 1, 1, 2), Solar=10.0, **{"Hydro Water Reservoir": 5.0}),  # one hydro part NULL
        _gen_row(datetime(2024, 1, 1, 3), **{"Hydro Pumped Storage": 7.0}),          # only pumped storage
        _gen_row(datetime(2024, 1, 1, 4), Nuclear=50.0, Solar=20.0, **{"Wind Onshore": 10.0,
                 "Fossil Gas": 10.0, "Biomass": 10.0}),
    ]
    t = _tables(spark, generation=rows)
    g = {r.date_key: r for r in t.table("fct_generation_hourly").collect()}
    assert g[2024010100].total_generation_mw == 0.0 and g[2024010100].renewable_pct is None
    assert g[2024010101].renewable_pct is None
    assert g[2024010102].renewable_mw == 15.0 and g[2024010102].renewable_pct == 100.0
    assert g[2024010103].total_generation_mw == 7.0 and g[2024010103].renewable_pct == 0.0
    r = g[2024010104]
    assert (r.total_generation_mw, r.renewable_mw, r.fossil_mw, r.renewable_pct) == (100.0, 30.0, 10.0, 30.0)
    for r in g.values():
        assert r.renewable_mw <= r.total_generation_mw
    assert t0


def test_hydro_in_monthly_mix_does_not_coalesce(spark):
    w = [(datetime(2024, 1, 1, h), 0.0, 1.0, 1.0, "Sofia", 42.7065, 23.3219) for h in range(2)]
    gen = [_gen_row(datetime(2024, 1, 1, 0), **{"Hydro Water Reservoir": 10.0, "Hydro Run-of-river and poundage": 2.0}),
           _gen_row(datetime(2024, 1, 1, 1), **{"Hydro Water Reservoir": 100.0})]
    m = MIX.monthly_mix(_tables(spark, weather=w, generation=gen)).first()
    assert m.hydro_mw == 12.0  # the hour missing one part drops out of the hydro average


def test_generation_shares_skip_zero_total(spark):
    gen = [_gen_row(datetime(2024, 1, 1, 0), Nuclear=50.0, Solar=50.0),
           _gen_row(datetime(2024, 1, 1, 1), Solar=0.0),
           _gen_row(datetime(2024, 1, 1, 2), Solar=10.0)]
    r = MIX.generation_shares(_tables(spark, generation=gen)).first()
    assert (r.avg_renewable_pct, r.avg_fossil_pct, r.avg_nuclear_pct) == (75.0, 0.0, 50.0)


def test_dim_city_keys_by_name_and_fanout(spark):
    w = [(datetime(2024, 1, 1, 0), 1.0, 1.0, 1.0, c, lat, lon) for c, lat, lon in S.CITIES]
    w.append((datetime(2024, 1, 1, 0), 1.0, 1.0, 1.0, "Ruse", 43.8, 25.9))
    t = _tables(spark, weather=w)
    keys = {r.city: (r.city_key, r.region, r.is_coastal) for r in t.table("dim_city").collect()}
    assert keys["Burgas"][0] == 1 and keys["Sofia"][0] == 5 and keys["Ruse"] == (4, None, False)
    assert t.table("fct_weather_hourly").count() == len(w)  # join keeps the row count

    # one city with two coordinate pairs gets two keys: its rows double in the fact
    w2 = w + [(datetime(2024, 1, 1, 1), 1.0, 1.0, 1.0, "Sofia", 42.0, 23.0)]
    t2 = _tables(spark, weather=w2)
    assert t2.table("dim_city").where("city = 'Sofia'").count() == 2
    assert t2.table("fct_weather_hourly").count() == len(w2) + 2


def test_dim_date_unique_keys(spark):
    w = [(datetime(2024, 1, 1, h), 0.0, 1.0, 1.0, c, lat, lon) for h in range(24) for c, lat, lon in S.CITIES]
    d = _tables(spark, weather=w).table("dim_date")
    assert d.count() == 24 and d.select("date_key").distinct().count() == 24


def test_repeated_autumn_hour_fans_out_and_is_reported(spark):
    ts = datetime(2024, 10, 27, 3)
    w = [(ts, 0.0, 1.0, 1.0, "Sofia", 42.7065, 23.3219)]
    p = [(ts, 10.0, "Bulgaria", "EUR", "MWh"), (ts, 20.0, "Bulgaria", "EUR", "MWh")]
    g = [_gen_row(ts, Solar=1.0), _gen_row(ts, Solar=2.0)]
    t = _tables(spark, weather=w, prices=p, generation=g)
    assert COR.price_renewable_pairs(t).count() == 4  # 2 x 2, kept, not silently deduplicated
    rep = {r.table_name: r for r in REG.QUERIES["sta_10_duplicate_key_report"](t).collect()}
    assert rep["fct_prices_hourly"].duplicate_keys == 1 and rep["fct_prices_hourly"].max_rows_per_key == 2


def test_correlation_degenerate_cases(spark):
    from hourmart.functions.stats import safe_corr

    def r(rows):
        df = spark.createDataFrame(rows, "x double, y double")
        return df.agg(safe_corr("x", "y").alias("r")).first().r

    assert r([(1.0, 2.0), (1.0, 3.0), (1.0, 4.0)]) is None      # constant column
    assert r([(1.0, 2.0)]) is None                              # one row
    assert r([]) is None                                        # empty
    assert r([(1.0, 1.0), (2.0, 2.0), (None, 50.0), (3.0, None), (4.0, 4.0)]) == pytest.approx(1.0)
    import numpy as np

    rng = np.random.default_rng(3)
    x = rng.normal(size=500)
    y = 0.3 * x + rng.normal(size=500)
    got = r([(float(a), float(b)) for a, b in zip(x, y)])
    assert got == pytest.approx(float(np.corrcoef(x, y)[0, 1]), abs=1e-12)


def test_heatmap_missing_season_row_is_null(spark):
    w = [(datetime(2024, 1, 1, h), 0.0, 1.0, 1.0, "Sofia", 42.7065, 23.3219) for h in range(24)]
    p = [(datetime(2024, 1, 1, h), float(h), "Bulgaria", "EUR", "MWh") for h in range(24)]
    hm = PR.price_heatmap(_tables(spark, weather=w, prices=p)).collect()
    assert [r.season for r in hm] == ["Winter", "Spring", "Summer", "Autumn"]
    assert hm[0].hour_13 == 13.0 and hm[1].hour_13 is None


def test_cheapest_and_dearest_hour_ties_go_to_lowest_hour(spark):
    w = [(datetime(2024, 1, 1, h), 0.0, 1.0, 1.0, "Sofia", 42.7065, 23.3219) for h in range(24)]
    price = {h: 50.0 for h in range(24)}
    price.update({3: 10.0, 7: 10.0, 20: 99.0, 21: 99.0})
    p = [(datetime(2024, 1, 1, h), price[h], "Bulgaria", "EUR", "MWh") for h in range(24)]
    r = PR.cheapest_dearest_hour(_tables(spark, weather=w, prices=p)).first()
    assert (r.cheapest_hour, r.cheapest_avg_price, r.dearest_hour, r.dearest_avg_price) == (3, 10.0, 20, 99.0)


def test_every_query_runs_on_empty_tables(spark):
    t = _tables(spark)
    for key, fn in REG.QUERIES.items():
        rows = fn(t).collect()
        if key in ("agg_16_row_counts",):
            assert all(r.row_count == 0 for r in rows)


def test_price_categories_add_up(spark):
    p = [(datetime(2024, 1, 1, h), float(v), "Bulgaria", "EUR", "MWh")
         for h, v in enumerate([-5, 0, 49.99, 50, 150, 200, 950, -0.01])]
    c = _tables(spark, prices=p).table("cleaned_prices")
    counts = {r.price_category: r["count"] for r in c.groupBy("price_category").count().collect()}
    assert sum(counts.values()) == len(p) and counts["Negative"] == 2 and counts["Very High"] == 2
    assert c.where(F.col("is_negative_price")).count() == 2


def test_exact_quantiles_match_sql_quantile_cont(spark):
    import duckdb
    import numpy as np

    from hourmart.functions.stats import exact_quantiles

    rng = np.random.default_rng(11)
    vals = (list(np.round(rng.gamma(2.0, 30.0, size=4000), 2)) + list(np.round(-rng.gamma(1.0, 3.0, size=300), 3))
            + [5.0] * 1500 + [0.0, -0.0, 1e9, None, float("nan")])
    df = spark.createDataFrame([(None if v is None else float(v),) for v in vals], "x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = list(exact_quantiles(df, "x", probs, buckets=16).first())
    clean = [float(v) for v in vals if v is not None and v == v]
    want = duckdb.execute(f"SELECT [{', '.join(f'quantile_cont(x, {p})' for p in probs)}] FROM "
                          f"(SELECT UNNEST(CAST(? AS DOUBLE[])) AS x)", [clean]).fetchall()[0][0]
    assert all(abs(a - b) <= 1e-12 * max(1.0, abs(b)) for a, b in zip(got, want))
    from pyspark.sql import functions as F

    no_nan = df.where(~F.isnan("x"))  # NaN is a missing value here (pandas / SQL rule), a value to Spark
    assert got == no_nan.agg(F.percentile("x", F.array(*[F.lit(p) for p in probs]))).first()[0]
    one = exact_quantiles(spark.createDataFrame([(3.0,)], "x double"), "x", [0.25, 0.5]).first()
    assert list(one) == [3.0, 3.0]
    empty = exact_quantiles(spark.createDataFrame([], "x double"), "x", [0.5]).first()
    assert list(empty) == [None]


def test_city_with_two_keys_uses_the_first(spark):
    w = [(datetime(2024, 1, 1, 12), 100.0, 1.0, 1.0, "Sofia", 42.7065, 23.3219),
         (datetime(2024, 1, 1, 12), 300.0, 1.0, 1.0, "Sofia", 42.0, 23.0)]
    t = _tables(spark, weather=w)
    from hourmart.plans import weather as WX

    r = WX.city_weather_kpis(t).first()  # no "more than one row" failure
    # the fact joins weather to dim_city by name, so each Sofia row meets both keys (the fan-out
    # the model has); the first key therefore sees both readings
    assert (r.avg_radiation, r.max_radiation) == (200.0, 300.0)
    assert WX.city_key_lookup(t).count() == 2
