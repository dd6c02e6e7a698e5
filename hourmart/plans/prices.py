"""Price views (AGG-07, AGG-08, AGG-13, AGG-14, AGG-19, SRT-05, SRT-06,
RSH-01, RSH-02)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourmart import schemas as S
from hourmart.functions.expr import clip_lower, half_away, literal_table
from hourmart.plans.common import with_dates
from hourmart.sources.catalog import Tables


def _prices(t: Tables, *date_cols: str) -> DataFrame:
    p = t.table("fct_prices_hourly").select("date_key", "price_eur_mwh", "is_negative_price")
    return with_dates(p, t, *date_cols)


def hourly_price_stats(t: Tables) -> DataFrame:
    """AGG-07: per hour of day, mean / min / max / sample std of price."""
    return (_prices(t, "hour").groupBy("hour")
            .agg(half_away(F.avg("price_eur_mwh"), 2).alias("avg_price"),
                 half_away(F.min("price_eur_mwh"), 2).alias("min_price"),
                 half_away(F.max("price_eur_mwh"), 2).alias("max_price"),
                 half_away(F.stddev_samp("price_eur_mwh"), 2).alias("price_volatility"))
            .orderBy(F.col("hour").asc_nulls_last()))


def hourly_price_band(t: Tables) -> DataFrame:
    """AGG-07 as the hourly chart frame: mean line and a min-max band whose
    lower edge is clipped at 0 (PRJ-27), plus the overall reference line
    (AGG-19) on every row."""
    h = hourly_price_stats(t)
    ref = h.agg(half_away(F.avg("avg_price"), 6)).scalar()
    return h.select("hour", "avg_price", clip_lower("min_price", 0.0).alias("band_low"),
                    F.col("max_price").alias("band_high"), ref.alias("overall_avg_price"))


def monthly_price_band(t: Tables) -> DataFrame:
    """AGG-14 as the monthly chart frame: min clipped at 0 (PRJ-27)."""
    m = monthly_prices(t)
    return m.select("month", "month_name", "avg_price", clip_lower("min_price", 0.0).alias("band_low"),
                    F.col("max_price").alias("band_high"))


def season_hour_prices(t: Tables) -> DataFrame:
    """AGG-08: mean price per (season, hour) in long form."""
    return (_prices(t, "season", "hour").groupBy("season", "hour")
            .agg(half_away(F.avg("price_eur_mwh"), 2).alias("avg_price"))
            .orderBy(F.col("hour").asc_nulls_last(), F.col("season").asc_nulls_last()))


def price_kpis(t: Tables) -> DataFrame:
    """AGG-13: mean / min / max price and negative-price hours."""
    p = t.table("fct_prices_hourly")
    return p.agg(half_away(F.avg("price_eur_mwh"), 2).alias("avg_price"),
                 half_away(F.min("price_eur_mwh"), 2).alias("min_price"),
                 half_away(F.max("price_eur_mwh"), 2).alias("max_price"),
                 F.count(F.when(F.col("is_negative_price"), F.lit(1))).cast("long").alias("negative_hours"))


def monthly_prices(t: Tables) -> DataFrame:
    """AGG-14: mean / min / max price per month."""
    return (_prices(t, "month", "month_name").groupBy("month", "month_name")
            .agg(half_away(F.avg("price_eur_mwh"), 2).alias("avg_price"),
                 half_away(F.min("price_eur_mwh"), 2).alias("min_price"),
                 half_away(F.max("price_eur_mwh"), 2).alias("max_price"))
            .orderBy(F.col("month").asc_nulls_last()))


def hourly_reference_line(t: Tables, digits: int = 6) -> DataFrame:
    """AGG-19: unweighted mean of the 24 hourly averages (chart reference line)."""
    h = hourly_price_stats(t)
    return h.agg(half_away(F.avg("avg_price"), digits).alias("overall_avg_price"))


def cheapest_dearest_hour(t: Tables) -> DataFrame:
    """SRT-05: hour with the lowest and the highest mean price.

    Ties go to the lowest hour (first row in hour order), decided by a
    (value, hour) struct key so the answer never depends on task order.
    """
    h = hourly_price_stats(t).where(F.col("avg_price").isNotNull())
    lo = F.min(F.struct("avg_price", "hour"))
    hi = F.max(F.struct("avg_price", (-F.col("hour")).alias("neg_hour")))
    return h.agg(lo.alias("_lo"), hi.alias("_hi")).select(
        F.col("_lo.hour").alias("cheapest_hour"),
        F.col("_lo.avg_price").alias("cheapest_avg_price"),
        (-F.col("_hi.neg_hour")).alias("dearest_hour"),
        F.col("_hi.avg_price").alias("dearest_avg_price"),
    )


def most_volatile_hour(t: Tables) -> DataFrame:
    """SRT-06: hour with the largest price standard deviation (ties: lowest hour)."""
    h = hourly_price_stats(t).where(F.col("price_volatility").isNotNull())
    hi = F.max(F.struct("price_volatility", (-F.col("hour")).alias("neg_hour")))
    return h.agg(hi.alias("_hi")).select(
        (-F.col("_hi.neg_hour")).alias("most_volatile_hour"),
        F.col("_hi.price_volatility").alias("price_volatility"),
    )


def price_heatmap(t: Tables) -> DataFrame:
    """RSH-01 + RSH-02: season x hour matrix of mean price.

    Pivot over the 24 listed hours as one conditional aggregate (no job to
    find the values, one shuffle), then reindex to Winter, Spring, Summer,
    Autumn: a season without data gives a row of NULLs, a row outside the
    list is dropped. The pivoted input has at most one row per season, so
    the reindex join is tiny.
    """
    spark = t.spark
    long = season_hour_prices(t)
    wide = long.groupBy("season").agg(
        *[F.max(F.when(F.col("hour") == F.lit(h), F.col("avg_price"))).alias(f"hour_{h}") for h in range(24)])
    order = literal_table(spark, list(enumerate(S.SEASON_ORDER)), ["season_order", "season"])
    return (order.join(wide, "season", "left")
            .orderBy("season_order")
            .drop("season_order"))
