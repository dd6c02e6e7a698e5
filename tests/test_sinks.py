"""Warehouse writes: zones, counts during the write, idempotent overwrite, catalog tables."""

import os

from hourmart import schemas as S
from hourmart.plans.registry import QUERIES
from hourmart.sinks.writer import build_warehouse, export_curated
from hourmart.sources.catalog import CatalogTables, DerivedTables, StoredTables, list_tables, register_external_tables

from conftest import SF_SMALL


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_build_warehouse_twice_equals_once(spark, scratch):
    base = os.path.join(scratch, "wh")
    derived = DerivedTables(spark, SF_SMALL)
    first = build_warehouse(spark, derived, base)
    second = build_warehouse(spark, DerivedTables(spark, SF_SMALL), base)
    assert first == second
    stored = StoredTables(spark, base)
    for name in S.ALL_TABLES:
        assert stored.table(name).count() == first[name]
        assert stored.table(name).columns == derived.table(name).columns
    for key in ["agg_06_seasonal_flagship", "agg_09_seasonal_summary", "sta_01_corr_renewable_price_detail",
                "rsh_01_price_heatmap", "agg_16_row_counts"]:
        assert _rows(QUERIES[key](stored)) == _rows(QUERIES[key](derived)), key


def test_partitions_and_curated_export(spark, scratch):
    base = os.path.join(scratch, "wh")
    build_warehouse(spark, DerivedTables(spark, SF_SMALL), base, period="date",
                    tables=["raw_weather", "raw_prices", "raw_generation", "cleaned_prices", "fct_prices_hourly"])
    parts = [d for d in os.listdir(os.path.join(base, "raw", "raw_prices")) if d.startswith("p_date=")]
    assert len(parts) > 100  # one folder per day under a daily feed
    out = os.path.join(scratch, "export")
    counts = export_curated(DerivedTables(spark, SF_SMALL), out)
    assert set(counts) == set(S.STAR_TABLES)
    assert all(os.path.isdir(os.path.join(out, "curated", t)) for t in S.STAR_TABLES)


def test_external_tables_in_catalog(spark, scratch):
    base = os.path.join(scratch, "wh")
    build_warehouse(spark, DerivedTables(spark, SF_SMALL), base)
    register_external_tables(spark, "hourmart_test", base)
    names = {r.table_name for r in list_tables(spark, "hourmart_test").collect()}
    assert set(S.ALL_TABLES) <= names
    cat = CatalogTables(spark, "hourmart_test")
    stored = StoredTables(spark, base)
    key = "agg_07_hourly_price_stats"
    assert _rows(QUERIES[key](cat)) == _rows(QUERIES[key](stored))


def test_bucketed_star_joins_without_exchange(spark, scratch):
    from hourmart.sinks.writer import save_star_as_bucketed_tables
    from test_plans import plan_text

    save_star_as_bucketed_tables(spark, DerivedTables(spark, SF_SMALL), "hourmart_bucketed", scratch, buckets=8)
    cat = CatalogTables(spark, "hourmart_bucketed")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # force the large-table strategy
    try:
        df = QUERIES["joi_08_price_renewable_pairs"](cat)
        text = plan_text(df, "simple")
        assert "SortMergeJoin" in text
        assert "Exchange hashpartitioning" not in text  # both sides read bucket-aligned
        derived = DerivedTables(spark, SF_SMALL)
        assert _rows(df) == _rows(QUERIES["joi_08_price_renewable_pairs"](derived))
        four_way = plan_text(QUERIES["agg_09_seasonal_summary"](cat), "simple")
        assert four_way.count("Exchange hashpartitioning(date_key") == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_raw_write_and_declared_schema_read(spark, scratch):
    from hourmart.sinks.writer import write_raw
    from hourmart.sources.landing import read_raw_parquet

    derived = DerivedTables(spark, SF_SMALL)
    for name in S.RAW_TABLES:
        path = os.path.join(scratch, name)
        n = write_raw(derived.table(name), path, name)
        back = read_raw_parquet(spark, path, name)
        assert [f.name for f in back.schema.fields][: len(S.RAW_SCHEMAS[name].fields)] == \
            [f.name for f in S.RAW_SCHEMAS[name].fields]
        assert back.count() == n == derived.table(name).count()


def test_full_build_replaces_periods_refresh_keeps_them(spark, scratch):
    from datetime import datetime

    from hourmart.sinks.writer import write_table

    path = os.path.join(scratch, "prices")
    rows = lambda years: spark.createDataFrame(
        [(datetime(y, 1, 1), 1.0, "Bulgaria", "EUR", "MWh") for y in years], S.RAW_PRICES)
    write_table(rows([2023, 2024]), path, "raw_prices")
    write_table(rows([2024]), path, "raw_prices")                      # full build: 2023 is gone
    assert sorted(r.p_year for r in spark.read.parquet(path).collect()) == [2024]
    write_table(rows([2025]), path, "raw_prices", replace="periods")   # refresh: 2024 stays
    assert sorted(r.p_year for r in spark.read.parquet(path).collect()) == [2024, 2025]


def test_sub_hourly_weather_fails_the_key_check(spark, scratch):
    from datetime import datetime

    import pytest

    from hourmart.sinks.writer import DuplicateKeyError, build_warehouse
    from hourmart.sources.catalog import LayeredTables

    w = [(datetime(2024, 1, 1, 10, m), 1.0, 1.0, 1.0, "Sofia", 42.7065, 23.3219) for m in (0, 30)]
    raw = LayeredTables(spark, {
        "raw_weather": spark.createDataFrame(w, S.RAW_WEATHER),
        "raw_prices": spark.createDataFrame([], S.RAW_PRICES),
        "raw_generation": spark.createDataFrame([], S.RAW_GENERATION),
    })
    with pytest.raises(DuplicateKeyError, match="2024010110"):
        build_warehouse(spark, raw, os.path.join(scratch, "wh"))
