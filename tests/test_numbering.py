"""Dense numbering over ranges equals a single-task row_number."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from hourmart.operators.numbering import numbered

from test_plans import plan_text


@pytest.mark.parametrize("ranges", [1, 4, 256])
def test_numbers_equal_row_number(spark, ranges):
    rng = random.Random(3)
    keys = {(f"Station {rng.randrange(10 ** 6):06d}", rng.choice([None, 1.5, 2.5])) for _ in range(2000)}
    keys |= {(None, None), (None, 1.0), ("Ähren", 2.0), ("", 0.0)}
    df = spark.createDataFrame(sorted(keys, key=str), "city string, latitude double")
    want = df.withColumn("n", F.row_number().over(Window.orderBy("city", "latitude")).cast("long"))
    got = numbered(df, ["city", "latitude"], "n", ranges=ranges)
    assert got.schema["n"].dataType.simpleString() == "bigint" and got.columns == ["city", "latitude", "n"]
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_nulls_last_and_empty(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "k string")
    assert {r.k: r.n for r in numbered(df, ["k"], "n", nulls_last=True).collect()} == {"a": 1, "b": 2, None: 3}
    assert numbered(df.limit(0), ["k"], "n").count() == 0


def test_no_single_task_window(spark):
    text = plan_text(numbered(spark.range(100).withColumnRenamed("id", "k"), ["k"], "n"), "simple")
    main = text.split("Subquery")[0].splitlines()
    window = next(i for i, line in enumerate(main) if "Window [" in line)
    below = next(line for line in main[window:] if "Exchange" in line)
    assert "hashpartitioning(_range" in below
