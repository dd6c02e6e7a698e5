"""Property tests: exact quantiles and rounding against the SQL engine on random data."""

import duckdb
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from hourmart.functions.expr import half_away
from hourmart.functions.stats import exact_quantiles

values = st.lists(st.one_of(st.integers(-500, 3000).map(lambda x: x / 100),
                            st.sampled_from([0.0, 5.0, 5.0, 5.0, -1.25, 1e6])),
                  min_size=1, max_size=300)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(vals=values, buckets=st.sampled_from([1, 3, 64]))
def test_exact_quantiles_property(spark, vals, buckets):
    from pyspark.sql import functions as F

    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = list(exact_quantiles(df, "x", probs, buckets=buckets).first())
    # bit for bit equal to Spark's single-task exact percentile
    single_task = df.agg(F.percentile("x", F.array(*[F.lit(p) for p in probs]))).first()[0]
    assert got == single_task
    # and to the SQL engine's quantile_cont up to the last bits of the interpolation
    want = duckdb.execute(f"SELECT [{', '.join(f'quantile_cont(x, {p})' for p in probs)}] "
                          "FROM (SELECT UNNEST(CAST(? AS DOUBLE[])) AS x)", [vals]).fetchall()[0][0]
    assert all(abs(a - b) <= 1e-12 * max(1.0, abs(b)) for a, b in zip(got, want))


def test_values_close_together_are_spread(spark):
    from pyspark.sql import functions as F

    from hourmart.functions.stats import rank_cells

    # a million times closer to each other than to the one far away: equal widths would put them into one cell
    df = spark.range(20_000).select((F.lit(1.0) + F.col("id") * F.lit(1e-13)).alias("x")).union(spark.sql("SELECT 1e9D AS x"))
    probs = [0.25, 0.5, 0.75]
    assert list(exact_quantiles(df, "x", probs).first()) == df.agg(F.percentile("x", F.array(*[F.lit(p) for p in probs]))).first()[0]
    counts = df.groupBy(F.col("x").alias("v")).agg(F.count("*").alias("c"))
    for rounds, most in ((1, 3000), (2, 200)):
        left = rank_cells(counts, probs, 64, rounds)
        sizes = [r["count"] for r in left.groupBy("off").count().collect()]
        assert len(sizes) <= 6 and max(sizes) <= most, (rounds, sizes)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(vals=st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=200),
       digits=st.integers(0, 3))
def test_half_away_property(spark, vals, digits):
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(half_away("x", digits)).collect()]
    want = [r[0] for r in duckdb.execute(f"SELECT ROUND(x, {digits}) FROM (SELECT UNNEST(CAST(? AS DOUBLE[])) AS x)",
                                         [vals]).fetchall()]
    assert got == want
