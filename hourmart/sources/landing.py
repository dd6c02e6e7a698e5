"""Landed files -> raw rows (SRC-05, ING-01..10, M19).

HTTP clients are not part of this package: fetchers land response files,
and these readers turn them into raw-table rows inside Spark.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourmart import schemas as S
from hourmart.functions.expr import literal_table, utc_to_local


def parse_landing_time(s: Column) -> Column:
    """ISO local time string (``2024-01-01T01:00``, seconds allowed) -> NTZ timestamp (ING-01); else the load fails."""
    return _with_seconds(s).cast("timestamp_ntz")


def _with_seconds(s: Column) -> Column:
    to_the_minute = s.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}$")
    return F.when(to_the_minute, F.concat(s, F.lit(":00"))).otherwise(s)


def is_landing_time(s: Column) -> Column:
    """Whether :func:`parse_landing_time` takes the string (NULL for NULL)."""
    return F.when(s.isNotNull(), _with_seconds(s).try_cast("timestamp_ntz").isNotNull())


def format_landing_time(ts: Column) -> Column:
    """NTZ timestamp -> ``yyyy-MM-ddTHH:mm`` without any time-zone step."""
    return F.substring(F.replace(ts.cast("string"), F.lit(" "), F.lit("T")), 1, 16)


def city_attributes(spark: SparkSession) -> DataFrame:
    """The fixed station list as a DataFrame (5 rows; safe to broadcast)."""
    return literal_table(spark, S.CITIES, ["city", "latitude", "longitude"])


def weather_rows(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Weather responses (one row per response, parallel hourly arrays) ->
    one row per hour and city with the raw_weather columns (plus ``keep``).

    ``arrays_zip`` + ``inline`` explode all arrays in step inside the task;
    a NULL element stays a NULL value, a shorter array pads with NULLs.
    """
    def arr(field: str, elem: str) -> Column:
        # a variable the response does not carry is an empty array, not NULL:
        # arrays_zip of a NULL array would drop the whole response
        return F.coalesce(F.col(f"hourly.{field}"), F.array().cast(f"array<{elem}>")).alias(field)

    h = docs.select(
        "city", "latitude", "longitude", *keep,
        arr("time", "string"),
        arr("shortwave_radiation", "double"),
        arr("windspeed_10m", "double"),
        arr("temperature_2m", "double"),
    )
    rows = h.select("city", "latitude", "longitude", *keep,
                    F.inline(F.arrays_zip("time", "shortwave_radiation", "windspeed_10m", "temperature_2m")))
    return rows.select(
        parse_landing_time(F.col("time")).alias("timestamp"),
        F.col("shortwave_radiation").cast("double").alias("shortwave_radiation_wm2"),
        F.col("windspeed_10m").cast("double").alias("windspeed_10m_kmh"),
        F.col("temperature_2m").cast("double").alias("temperature_2m_c"),
        "city", "latitude", "longitude", *keep,
    )


def with_city_attributes(rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Fill missing coordinates from the fixed station list (ING-02).

    The station list is a constant of five rows, so it is broadcast; rows of
    an unknown city keep whatever coordinates they carry.
    """
    cities = F.broadcast(city_attributes(rows.sparkSession)
                         .withColumnsRenamed({"latitude": "_lat", "longitude": "_lon"}))
    return (rows.join(cities, "city", "left")
            .withColumn("latitude", F.coalesce("latitude", "_lat"))
            .withColumn("longitude", F.coalesce("longitude", "_lon"))
            .select(*[f.name for f in S.RAW_WEATHER.fields], *keep))


def read_weather_landing(spark: SparkSession, path: str) -> DataFrame:
    """Read landed weather JSON (one response object per file or per line)."""
    texts = spark.read.text(path, wholetext=True)
    return with_city_attributes(weather_rows(json_documents(texts, S.WEATHER_LANDING)))


def json_documents(texts: DataFrame, schema: T.StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """Whole landed files (column ``value``) -> one row per JSON object in them.

    A file whose non-blank lines all are objects is JSON lines; any other must
    be a single document. What is neither, or does not parse, fails the load.
    """
    lines = F.filter(F.transform(F.split("value", "\n"), F.trim), lambda x: x != "")
    by_line = (F.size(lines) > 1) & F.forall(lines, lambda x: x.startswith("{") & x.rlike(r"\}$"))
    single = F.when(F.json_array_length(F.concat(F.lit("["), F.col("value"), F.lit("]"))) == 1, F.array("value")) \
        .otherwise(F.array(F.raise_error("a landed file is neither one JSON document nor JSON lines").cast("string")))
    docs = texts.select(*keep, F.explode(F.when(by_line, lines).otherwise(single)).alias("value"))
    parsed = docs.select(*keep, F.from_json("value", schema, {"mode": "FAILFAST"}).alias("d"))
    return parsed.select("d.*", *keep)


def weather_days(raw_weather: DataFrame) -> DataFrame:
    """raw_weather rows -> one row per (city, day), its hours in an array (``_rows``) in time order.

    Each group holds at most 24 hours (plus a repeated autumn hour), so the
    arrays stay small however long the history is.
    """
    # the day leads: a sort of the groups compares dates before names, which may share their beginnings
    return (raw_weather
            .groupBy(F.to_date("timestamp").alias("_day"), "city", "latitude", "longitude")
            .agg(F.sort_array(F.collect_list(F.struct(
                format_landing_time(F.col("timestamp")).alias("time"),
                F.col("shortwave_radiation_wm2").alias("shortwave_radiation"),
                F.col("windspeed_10m_kmh").alias("windspeed_10m"),
                F.col("temperature_2m_c").alias("temperature_2m")))).alias("_rows")))


def days_as_docs(days: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows of :func:`weather_days` -> landing documents (plus ``keep``)."""
    return days.select(
        *keep, "city", "latitude", "longitude",
        F.struct(*[F.col(f"_rows.{f}").alias(f)
                   for f in ["time", "shortwave_radiation", "windspeed_10m", "temperature_2m"]]).alias("hourly"))


def weather_landing_docs(raw_weather: DataFrame) -> DataFrame:
    """raw_weather rows -> landing documents, one per (city, day)."""
    return days_as_docs(weather_days(raw_weather))


def to_json_lines(docs: DataFrame) -> DataFrame:
    return docs.select(F.to_json(F.struct(*docs.columns)).alias("value"))


def from_json_lines(lines: DataFrame, schema: T.StructType = S.WEATHER_LANDING) -> DataFrame:
    return lines.select(F.from_json("value", schema).alias("d")).select("d.*")


def prices_from_utc(series: DataFrame, ts_col: str = "timestamp_utc", price_col: str = "price",
                    zone: str = S.MARKET_TIME_ZONE) -> DataFrame:
    """(UTC instant, price) series -> raw_prices rows on the local wall clock
    (ING-03, ING-04, ING-06). Both autumn hours that fall on the same local
    hour are kept."""
    return series.select(
        utc_to_local(F.col(ts_col), zone).alias("timestamp"),
        F.col(price_col).cast("double").alias("price_eur_mwh"),
        F.lit(S.MARKET_COUNTRY).alias("country"),
        F.lit(S.MARKET_CURRENCY).alias("currency"),
        F.lit(S.MARKET_UNIT).alias("unit"),
    )


def generation_long(raw_generation: DataFrame) -> DataFrame:
    """Wide generation table -> (timestamp, country, source, mw), absent values dropped;
    an hour without any value keeps one row, of the first source with NULL, so it is not lost."""
    sources = [F.col(f"`{src}`") for src, _ in S.GENERATION_SOURCES]
    names = [src for src, _ in S.GENERATION_SOURCES]
    empty = F.coalesce(*[F.col(f"`{n}`") for n in names]).isNull()
    return (raw_generation.withColumn("_empty", empty)
            .unpivot(["timestamp", "country", "_empty"], sources, "source", "mw")
            .where(F.col("mw").isNotNull() | (F.col("_empty") & (F.col("source") == F.lit(names[0])))).drop("_empty"))


def generation_wide(long: DataFrame, keys: tuple[str, ...] = ("timestamp", "country")) -> DataFrame:
    """(timestamp, country, source, mw) -> one column per source (ING-10).

    A pivot over the 11 listed sources written as one conditional aggregate:
    no job to discover the values, an absent source is a NULL column, and a
    single shuffle of partially aggregated wide rows (``pivot`` would first
    shuffle the long rows by (timestamp, country, source), then again).
    """
    names = [src for src, _ in S.GENERATION_SOURCES]
    wide = long.groupBy(*keys).agg(
        *[F.max(F.when(F.col("source") == F.lit(n), F.col("mw"))).cast("double").alias(n) for n in names])
    extra = [k for k in keys if k not in ("timestamp", "country")]
    return wide.select("timestamp", *[F.col(f"`{n}`") for n in names], "country", *extra)


def flatten_headers(df: DataFrame, sep: str = "_") -> DataFrame:
    """Two-level column headers (struct columns) -> ``parent<sep>child`` (ING-07)."""
    cols: list[Column] = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StructType):
            cols += [F.col(f"`{f.name}`.`{c.name}`").alias(f"{f.name}{sep}{c.name}".strip())
                     for c in f.dataType.fields]
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(cols)


def check_raw_schema(df: DataFrame, table: str) -> DataFrame:
    """Select the declared raw columns in order and cast them (fail on missing)."""
    schema = S.RAW_SCHEMAS[table]
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"{table}: missing column(s) {missing}")
    return df.select([F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def read_raw_parquet(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Raw Parquet as the declared columns (SRC-01..04); a missing one fails, nanosecond times are converted.

    The footer's schema is read to see both; the data is cast to the declared types.
    """
    spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")  # see NANOS in hourmart.session
    df = spark.read.parquet(path)
    times = [f.name for f in S.RAW_SCHEMAS[table].fields if f.dataType.simpleString().startswith("timestamp")]
    longs = {c: nanos_to_ntz(F.col(c)) for c in times if c in df.columns and df.schema[c].dataType == T.LongType()}
    return check_raw_schema(df.withColumns(longs) if longs else df, table)


def read_partitions(spark: SparkSession, path: str, pcol: str, values: list, schema) -> DataFrame | None:
    """Rows of the existing table in the given period partitions only.

    The folders are named directly (one brace glob), so neither the other
    partitions nor the table's full folder list is ever touched; the
    declared schema spares the footer reads. None when none exist yet.
    """
    if not values:
        return None
    names = ",".join("__HIVE_DEFAULT_PARTITION__" if v is None else str(v) for v in values)
    try:
        return (spark.read.schema(schema).option("basePath", path)
                .parquet(f"{path.rstrip('/')}/{pcol}={{{names}}}"))
    except AnalysisException as e:  # first load of these periods
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise


def nanos_to_ntz(col: Column) -> Column:
    """Epoch nanoseconds (a nanosecond Parquet timestamp read as long) -> NTZ.

    Pure interval arithmetic from the epoch: no session time zone involved.
    Needs ``spark.sql.legacy.parquet.nanosAsLong=true`` on the reading session.
    """
    return micros_to_ntz(F.call_function("div", col - F.pmod(col, F.lit(1000)), F.lit(1000)))


def micros_to_ntz(micros: Column) -> Column:
    """Epoch microseconds -> NTZ holding the UTC clock, in whole-number arithmetic."""
    seconds = (micros.cast("decimal(20,0)") * F.lit("0.000001").cast("decimal(7,6)")).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def dedupe_latest(df: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """Keep one row per key: the one with the largest ``order_col``.

    A max over a struct per key: a plain aggregate (partial per task), not a
    window sort, and no row is moved twice.
    """
    others = [c for c in df.columns if c not in keys]
    best = F.max(F.struct(F.col(order_col).alias("_o"), *[F.col(f"`{c}`") for c in others])).alias("_b")
    out = df.groupBy(*keys).agg(best)
    return out.select(*keys, *[F.col(f"_b.`{c}`").alias(c) for c in others]).select(*df.columns)



def read_parquet_nanos(spark: SparkSession, path: str, ts_cols: list[str]) -> DataFrame:
    """Read Parquet whose timestamps were written with nanosecond precision.

    Spark has no nanosecond timestamp type; with
    ``spark.sql.legacy.parquet.nanosAsLong`` the column arrives as epoch
    nanoseconds (set on the session, because the scan reads the flag when it
    runs) and :func:`nanos_to_ntz` turns it into a wall-clock timestamp.
    """
    spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    df = spark.read.parquet(path)
    return df.withColumns({c: nanos_to_ntz(F.col(c)) for c in ts_cols})


def restrict_range(df: DataFrame, start: str, end: str, ts_col: str = "timestamp") -> DataFrame:
    """Keep rows with ``start <= ts <= end`` on the local wall clock (ING-05).

    Bounds are local-time strings (``'2024-01-01'`` or ``'2024-12-31 00:00'``)
    compared as NTZ values, so the filter is pushed to the Parquet scan as a
    plain range and never shifts with the session zone. The end bound is
    inclusive, as in the feed requests.
    """
    lo = F.lit(start).cast("timestamp_ntz")
    hi = F.lit(end).cast("timestamp_ntz")
    return df.where(F.col(ts_col).between(lo, hi))


# Landed market feeds: one JSON object per line, instants in UTC.
PRICE_LANDING = T.StructType([T.StructField("timestamp_utc", T.StringType()),
                              T.StructField("price", T.DoubleType())])
GENERATION_LANDING = T.StructType([T.StructField("timestamp_utc", T.StringType()),
                                   T.StructField("source", T.StringType()),
                                   T.StructField("mw", T.DoubleType())])


def _with_offset(s: Column) -> Column:
    zoned = F.when(s.rlike(r"(Z|[+-]\d{2}:?\d{2})$"), s).otherwise(F.concat(s, F.lit("Z")))
    return F.regexp_replace(zoned, r"([+-]\d{2})(\d{2})$", "$1:$2")


def parse_utc_instant(s: Column) -> Column:
    """ISO instant string (``...Z``, any offset, or bare UTC) -> NTZ holding the UTC clock."""
    return micros_to_ntz(F.unix_micros(F.to_timestamp(_with_offset(s))))


def is_utc_instant(s: Column) -> Column:
    """Whether :func:`parse_utc_instant` takes the string (NULL for NULL)."""
    return F.when(s.isNotNull(), _with_offset(s).try_cast("timestamp").isNotNull())


def price_rows(landed: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Landed (timestamp_utc, price) lines -> raw_prices rows + ``timestamp_utc``."""
    utc = landed.select(parse_utc_instant(F.col("timestamp_utc")).alias("timestamp_utc"), "price", *keep)
    return utc.select(
        utc_to_local(F.col("timestamp_utc")).alias("timestamp"),
        F.col("price").cast("double").alias("price_eur_mwh"),
        F.lit(S.MARKET_COUNTRY).alias("country"),
        F.lit(S.MARKET_CURRENCY).alias("currency"),
        F.lit(S.MARKET_UNIT).alias("unit"),
        "timestamp_utc", *keep)


def generation_rows(landed: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Landed (timestamp_utc, source, mw) lines -> raw_generation rows + ``timestamp_utc``.

    One row per UTC hour: the two autumn hours that share a local hour stay
    two rows, as the feed delivers them.
    """
    long = landed.select(parse_utc_instant(F.col("timestamp_utc")).alias("timestamp_utc"), "source", "mw", *keep)
    long = long.select(utc_to_local(F.col("timestamp_utc")).alias("timestamp"), F.lit(S.MARKET_COUNTRY).alias("country"),
                       "timestamp_utc", "source", "mw", *keep)
    return generation_wide(long, ("timestamp", "country", "timestamp_utc", *keep))
