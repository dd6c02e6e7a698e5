"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as E  # noqa: E402
from hourmart.oracle import ORACLE_SQL  # noqa: E402
from hourmart.plans.registry import QUERIES  # noqa: E402
from hourmart.plans.storage import STORAGE_QUERIES  # noqa: E402
from compare_oracle import TABLES, families, value_hash  # noqa: E402

from conftest import SF_SMALL  # noqa: E402


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) | set(STORAGE_QUERIES) == set(ORACLE_SQL)
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, key):
    sdf = E.queries()[key](spark, SF_SMALL).toArrow()
    odf = con.execute(E.oracle_sql()[key]).to_arrow_table()
    assert len(sdf) == len(odf)
    assert sorted(sdf.column_names) == sorted(odf.column_names)
    assert families(sdf) == families(odf)
    assert value_hash(sdf) == value_hash(odf)


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) >= 1
    assert df.columns == ["season", "avg_solar_radiation", "avg_solar_generation_mw", "avg_renewable_pct",
                          "avg_price_eur_mwh"]
