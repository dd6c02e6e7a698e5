"""Column helpers on hand-made edge rows (expected values written out)."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourmart.functions import expr as X

NAN = float("nan")


def _col(spark, values, name="x", dtype=T.DoubleType()):
    return spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField(name, dtype)]))


def test_radiation_category_and_daytime_edges(spark):
    vals = [None, NAN, -5.0, 0.0, 0.1, 99.9, 100.0, 399.9, 400.0, 699.9, 700.0]
    df = _col(spark, vals).select(
        F.monotonically_increasing_id().alias("i"), "x",
        X.radiation_category("x").alias("cat"), X.is_daytime("x").alias("day"))
    got = [(r.cat, r.day) for r in df.orderBy("i").collect()]
    assert got == [
        ("Very High", False),  # NULL falls to ELSE; not daytime
        ("Very High", True),   # NaN sorts above every number
        ("Low", False),        # negative is Low (only = 0 is None)
        ("None", False),
        ("Low", True), ("Low", True),
        ("Medium", True), ("Medium", True),
        ("High", True), ("High", True),
        ("Very High", True),
    ]


def test_price_category_edges(spark):
    vals = [None, -0.01, 0.0, 49.99, 50.0, 99.99, 100.0, 199.99, 200.0, 950.0]
    df = _col(spark, vals).select(F.monotonically_increasing_id().alias("i"),
                                  X.price_category("x").alias("c"), X.is_negative_price("x").alias("n"))
    got = [(r.c, r.n) for r in df.orderBy("i").collect()]
    assert got == [("Very High", False), ("Negative", True), ("Low", False), ("Low", False),
                   ("Medium", False), ("Medium", False), ("High", False), ("High", False),
                   ("Very High", False), ("Very High", False)]


@pytest.mark.parametrize("value,digits,expected", [
    (1.005, 2, 1.0), (2.675, 2, 2.68), (0.15, 1, 0.2), (-2.5, 0, -3.0), (2.5, 0, 3.0), (None, 1, None)])
def test_half_away(spark, value, digits, expected):
    got = _col(spark, [value]).select(X.half_away("x", digits).alias("r")).first().r
    assert got == expected


def test_half_away_equals_sql_round_on_many_values(spark):
    import random

    rnd = random.Random(7)
    vals = [round(rnd.uniform(-1000, 1000), 3) for _ in range(3000)] + [x / 1000 for x in range(-2000, 2000, 5)]
    got = [r.r for r in _col(spark, vals).select(X.half_away("x", 2).alias("r")).collect()]
    con = duckdb.connect()
    want = [r[0] for r in con.execute("SELECT ROUND(x, 2) FROM (SELECT UNNEST(?) AS x)", [vals]).fetchall()]
    assert got == want


def test_season_and_calendar(spark):
    from datetime import datetime

    rows = [(datetime(2024, 2, 29, 12, 0),), (datetime(2024, 12, 31, 23, 0),), (datetime(2024, 3, 1, 0, 0),),
            (datetime(2024, 6, 1, 5, 0),), (datetime(2024, 9, 1, 22, 0),), (None,)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz").select(
        F.monotonically_increasing_id().alias("i"),
        X.season(F.month("ts")).alias("s"), X.date_key("ts").alias("k"),
        X.month_name("ts").alias("m"), X.day_name("ts").alias("d"),
        X.weekday0("ts").alias("w"), X.is_business_hours("ts").alias("b"), X.is_weekend("ts").alias("we"))
    got = [tuple(r)[1:] for r in df.orderBy("i").collect()]
    assert got == [
        ("Winter", 2024022912, "February", "Thursday", 4, True, False),
        ("Winter", 2024123123, "December", "Tuesday", 2, False, False),
        ("Spring", 2024030100, "March", "Friday", 5, False, False),
        ("Summer", 2024060105, "June", "Saturday", 6, False, True),
        ("Autumn", 2024090122, "September", "Sunday", 0, False, True),
        (None, None, None, None, None, False, False),
    ]


def test_business_hours_edges(spark):
    from datetime import datetime

    df = spark.createDataFrame([(datetime(2024, 1, 6, h),) for h in (5, 6, 21, 22)], "ts timestamp_ntz")
    assert [r.b for r in df.select(X.is_business_hours("ts").alias("b")).collect()] == [False, True, True, False]


@pytest.mark.parametrize("zone", ["UTC", "Europe/Sofia", "America/New_York"])
def test_clock_keys_do_not_depend_on_session_zone(spark, zone):
    from datetime import datetime

    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = [(datetime(2024, 3, 31, 3, 30),), (datetime(2024, 10, 27, 3, 0),), (datetime(2024, 10, 27, 3, 0),)]
        df = spark.createDataFrame(rows, "ts timestamp_ntz")
        got = [r.k for r in df.select(X.date_key("ts").alias("k")).collect()]
        assert got == [2024033103, 2024102703, 2024102703]
        names = df.select(X.day_name("ts").alias("d"), X.month_name("ts").alias("m")).first()
        assert (names.d, names.m) == ("Sunday", "March")
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_utc_to_local_keeps_both_autumn_hours(spark):
    from datetime import datetime

    rows = [(datetime(2024, 10, 27, 0, 0),), (datetime(2024, 10, 27, 1, 0),), (datetime(2024, 3, 31, 1, 0),)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz").select(X.utc_to_local("ts").alias("l"))
    assert [r.l for r in df.collect()] == [datetime(2024, 10, 27, 3, 0), datetime(2024, 10, 27, 3, 0),
                                           datetime(2024, 3, 31, 4, 0)]


def test_region_and_coastal(spark):
    df = spark.createDataFrame([("Varna",), ("Sofia",), ("Ruse",), (None,)], "city string").select(
        X.city_region("city").alias("r"), X.is_coastal("city").alias("c"))
    assert [(r.r, r.c) for r in df.collect()] == [("Northeast", True), ("Southwest", False), (None, False),
                                                  (None, False)]


def test_bucket_and_clip(spark):
    df = _col(spark, [0.0, 9.99, 10.0, 55.5, 100.0, -0.5, None]).select(
        X.bucket("x").alias("b"), X.clip_lower("x").alias("c"))
    got = [(r.b, r.c) for r in df.collect()]
    assert got == [(0, 0.0), (0, 9.99), (10, 10.0), (50, 55.5), (100, 100.0), (-10, 0.0), (None, None)]


def test_share_pct_zero_total_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 4.0), (None, 4.0)], "a double, t double")
    got = [r.p for r in df.select(X.share_pct("a", "t", 2).alias("p")).collect()]
    assert got == [None, 25.0, None]
    assert math.isclose(df.select(X.share_pct("a", "t").alias("p")).collect()[1].p, 25.0)


def test_scale_conf_sizes_partitions():
    from hourmart.session import scale_conf

    c = scale_conf(100 * 1024 ** 4, executors=1000, cores_per_executor=8)
    assert int(c["spark.sql.shuffle.partitions"]) == 100 * 1024 ** 4 // (256 * 1024 ** 2) + 1
    small = scale_conf(10 * 1024 ** 2, executors=2, cores_per_executor=4)
    assert small["spark.sql.shuffle.partitions"] == "24"
