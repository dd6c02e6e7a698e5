"""Energy-mix views (AGG-03, AGG-04, AGG-12)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourmart.functions.expr import half_away, share_pct
from hourmart.plans.common import with_dates
from hourmart.sources.catalog import Tables


def monthly_mix(t: Tables, with_total: bool = True) -> DataFrame:
    """AGG-03: monthly average output per source.

    Hydro is reservoir + run-of-river with plain ``+``: an hour missing
    either part is left out of the hydro average (unlike the totals, which
    count a missing source as 0).
    """
    g = t.table("fct_generation_hourly").select(
        "date_key", "nuclear_mw", "lignite_mw", "solar_mw", "wind_onshore_mw",
        "hydro_reservoir_mw", "hydro_river_mw", "gas_mw", "renewable_pct", "total_generation_mw")
    aggs = [
        half_away(F.avg("nuclear_mw"), 1).alias("nuclear_mw"),
        half_away(F.avg("lignite_mw"), 1).alias("lignite_mw"),
        half_away(F.avg("solar_mw"), 1).alias("solar_mw"),
        half_away(F.avg("wind_onshore_mw"), 1).alias("wind_mw"),
        half_away(F.avg(F.col("hydro_reservoir_mw") + F.col("hydro_river_mw")), 1).alias("hydro_mw"),
        half_away(F.avg("gas_mw"), 1).alias("gas_mw"),
        half_away(F.avg("renewable_pct"), 1).alias("renewable_pct"),
    ]
    if with_total:
        aggs.append(half_away(F.avg("total_generation_mw"), 1).alias("total_mw"))
    return (with_dates(g, t, "month", "month_name")
            .groupBy("month", "month_name").agg(*aggs)
            .orderBy(F.col("month").asc_nulls_last()))


def generation_shares(t: Tables) -> DataFrame:
    """AGG-04: average renewable / fossil / nuclear share of hourly output,
    over hours with output (a missing nuclear value leaves that hour out of
    the nuclear average only)."""
    g = t.table("cleaned_generation").where(F.col("total_generation_mw") > F.lit(0.0))
    return g.agg(
        half_away(F.avg(share_pct("renewable_mw", "total_generation_mw")), 1).alias("avg_renewable_pct"),
        half_away(F.avg(share_pct("fossil_mw", "total_generation_mw")), 1).alias("avg_fossil_pct"),
        half_away(F.avg(share_pct("nuclear_mw", "total_generation_mw")), 1).alias("avg_nuclear_pct"),
    )


def generation_kpis(t: Tables, naming: str = "overview") -> DataFrame:
    """AGG-12: four headline averages of the generation fact.

    ``naming="overview"`` and ``naming="insights"`` give the two published
    column layouts of the same numbers.
    """
    g = t.table("fct_generation_hourly")
    ren = half_away(F.avg("renewable_pct"), 1)
    nuc = half_away(F.avg("nuclear_mw"), 0)
    tot = half_away(F.avg("total_generation_mw"), 0)
    sol = half_away(F.avg("solar_mw"), 0)
    if naming == "overview":
        return g.agg(ren.alias("avg_renewable_pct"), nuc.alias("avg_nuclear_mw"),
                     tot.alias("avg_total_mw"), sol.alias("avg_solar_mw"))
    if naming == "insights":
        return g.agg(tot.alias("avg_total"), ren.alias("avg_renewable"),
                     nuc.alias("avg_nuclear"), sol.alias("avg_solar"))
    raise ValueError(f"unknown naming {naming!r}")


def generation_kpi_cards(t: Tables) -> DataFrame:
    """AGG-12 as display cards: MW figures as whole numbers (PRJ-29)."""
    k = generation_kpis(t, "overview")
    return k.select(
        "avg_renewable_pct",
        F.col("avg_nuclear_mw").cast("int").alias("avg_nuclear_mw"),
        F.col("avg_total_mw").cast("int").alias("avg_total_mw"),
        F.col("avg_solar_mw").cast("int").alias("avg_solar_mw"),
    )
