"""Column -> Column helpers.

All helpers are built from ``pyspark.sql.functions`` so they stay inside
whole-stage codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from hourmart import schemas as S


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def half_away(col: Column | str, digits: int = 0) -> Column:
    """Round half away from zero on the binary value.

    ``F.round(x, 2)`` rounds the shortest decimal text of ``x`` (1.005 ->
    1.01); SQL engines that scale first give 1.0. Scaling by 10^n, rounding
    to an integer and scaling back gives the same answer as those engines.
    """
    c = _c(col)
    if digits == 0:
        return F.round(c, 0)
    scale = float(10 ** digits)
    return F.round(c * F.lit(scale), 0) / F.lit(scale)


def weekday0(ts: Column | str) -> Column:
    """Day of week, 0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(_c(ts)) - F.lit(1)


def date_key(ts: Column | str) -> Column:
    """Integer YYYYMMDDHH of a wall-clock (NTZ) timestamp.

    Computed from date parts, not by formatting, so the session time zone
    can never shift the hour.
    """
    t = _c(ts)
    return (F.year(t) * F.lit(1000000) + F.month(t) * F.lit(10000)
            + F.dayofmonth(t) * F.lit(100) + F.hour(t)).cast("int")


def date_key_year(key: Column | str) -> Column:
    """Year part of a YYYYMMDDHH key (used as the partition column)."""
    return (_c(key) / F.lit(1000000)).cast("int")


def season(month: Column | str) -> Column:
    m = _c(month)
    out = None
    for name, months in S.SEASON_MONTHS:
        out = (F.when(m.isin(*months), F.lit(name)) if out is None
               else out.when(m.isin(*months), F.lit(name)))
    return out


def is_daytime(radiation: Column | str) -> Column:
    """TRUE when radiation > 0; NULL and non-positive values give FALSE."""
    return F.when(_c(radiation) > F.lit(0.0), F.lit(True)).otherwise(F.lit(False))


def radiation_category(radiation: Column | str) -> Column:
    r = _c(radiation)
    out = F.when(r == F.lit(S.RADIATION_NONE_AT), F.lit("None"))
    for edge, label in S.RADIATION_LADDER:
        out = out.when(r < F.lit(edge), F.lit(label))
    return out.otherwise(F.lit("Very High"))


def price_category(price: Column | str) -> Column:
    p = _c(price)
    out = None
    for edge, label in S.PRICE_LADDER:
        out = (F.when(p < F.lit(edge), F.lit(label)) if out is None
               else out.when(p < F.lit(edge), F.lit(label)))
    return out.otherwise(F.lit("Very High"))


def is_negative_price(price: Column | str) -> Column:
    return F.when(_c(price) < F.lit(0.0), F.lit(True)).otherwise(F.lit(False))


def coalesce_sum(cols: list[str]) -> Column:
    """Sum that counts a missing term as 0 (left-to-right order kept)."""
    return reduce(add, [F.coalesce(F.col(c), F.lit(0.0)) for c in cols])


def share_pct(part: Column | str, total: Column | str, digits: int | None = None) -> Column:
    """part / total * 100, NULL when total is 0 or NULL (no division error)."""
    pct = _c(part) / F.nullif(_c(total), F.lit(0.0)) * F.lit(100.0)
    return pct if digits is None else half_away(pct, digits)


def _lookup(names: list[str], index0: Column) -> Column:
    # ``get`` (0-based) returns NULL for a NULL index; ``element_at`` on a
    # literal array returned the last element for a NULL index in tests.
    return F.get(F.array(*[F.lit(n) for n in names]), index0)


def month_name(ts: Column | str) -> Column:
    """English month name, independent of locale and session zone."""
    return _lookup(S.MONTH_NAMES, F.month(_c(ts)) - F.lit(1))


def day_name(ts: Column | str) -> Column:
    return _lookup(S.DAY_NAMES, F.dayofweek(_c(ts)) - F.lit(1))


def is_weekend(ts: Column | str) -> Column:
    return F.when(weekday0(ts).isin(*S.WEEKEND_DAYS), F.lit(True)).otherwise(F.lit(False))


def is_business_hours(ts: Column | str) -> Column:
    return (F.when(F.hour(_c(ts)).between(S.BUSINESS_HOUR_FIRST, S.BUSINESS_HOUR_LAST), F.lit(True))
            .otherwise(F.lit(False)))


def city_region(city: Column | str) -> Column:
    """Region of a known city; unknown cities give NULL."""
    c = _c(city)
    out = None
    for name, region in S.CITY_REGIONS.items():
        out = (F.when(c == F.lit(name), F.lit(region)) if out is None
               else out.when(c == F.lit(name), F.lit(region)))
    return out


def is_coastal(city: Column | str) -> Column:
    return F.when(_c(city).isin(*S.COASTAL_CITIES), F.lit(True)).otherwise(F.lit(False))


def bucket(col: Column | str, width: int = 10) -> Column:
    """Floor-division bucket: floor(x / width) * width as int (NULL stays NULL)."""
    return (F.floor(_c(col) / F.lit(float(width))) * F.lit(width)).cast("int")


def clip_lower(col: Column | str, lower: float = 0.0) -> Column:
    """Clip below ``lower``; NULL stays NULL (``greatest`` would not keep it)."""
    c = _c(col)
    return F.when(c < F.lit(lower), F.lit(lower)).otherwise(c)


def utc_to_local(ts_utc: Column | str, zone: str = S.MARKET_TIME_ZONE) -> Column:
    """UTC instant (NTZ) -> local wall clock (NTZ) with the zone dropped.

    In autumn two UTC hours map to the same local hour; both rows are kept.
    """
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), _c(ts_utc))


def local_hour_slot(base: str, hours: Column) -> Column:
    """NTZ timestamp ``base`` plus a whole number of hours."""
    return F.lit(base).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), hours.cast("int"))


def literal_table(spark, rows: list[tuple], names: list[str]):
    """A small fixed table built JVM-side (``inline`` over literal structs).

    Unlike ``createDataFrame`` from a Python list, no Python RDD and no
    Python worker are involved; the plan is a one-row range plus a generator.
    """
    structs = [F.struct(*[F.lit(v).alias(n) for v, n in zip(r, names)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
