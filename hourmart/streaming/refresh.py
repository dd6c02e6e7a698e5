"""Daily refresh of the raw zone (SNK-07) as Structured Streaming.

Landed weather responses arrive as files in a landing folder. A file-source
stream picks up new files (``trigger(availableNow=True)`` processes what is
there and stops, which is how a daily scheduled run uses it); every
micro-batch is merged into the raw table with :func:`merge_into_partitions`:

* rows are keyed by (timestamp, city); a later landed file wins, whatever
  the order in which files are loaded (the landing time is stored);
* only the partitions the batch touches are read and rewritten (dynamic
  partition overwrite), so a day's load costs a day's data, not the table;
* a batch's rows are parsed once: they are written beside the table first, and
  every later step reads them from there;
* old and new rows are dealt to the tasks by key once, sorted once, merged and
  written: a dynamic overwrite keeps what it writes in a staging folder and
  replaces the partitions when all tasks are done, so the job may read them;
* a batch that is replayed after a failure produces the same table, so the
  refresh is idempotent: running a day's load twice equals running it once.

The stream's own checkpoint (offsets, processed files) lives under the
shared folder too, so a restarted driver resumes where it stopped.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from hourmart import schemas as S
from hourmart.session import kept_aside
from hourmart.sinks.writer import partition_column, with_period
from hourmart.sources.landing import (GENERATION_LANDING, PRICE_LANDING, dedupe_latest, generation_rows,
                                      json_documents, price_rows, read_partitions, weather_rows,
                                      with_city_attributes)
from hourmart.sources.rejects import good, judged_once, read_judged, store_rejects
from hourmart.streaming.propagate import refresh_dependants

ORDER_COL = "_landed_at"
#: In a merge: all columns of a row without a whole key, NULL for the others.
WHOLE = "_whole"
WEATHER_KEYS = ["timestamp", "city"]
# Market feeds are keyed on the UTC instant: the two autumn hours that share a
# local wall-clock hour are two rows, as the feed delivers them.
MARKET_KEYS = ["timestamp_utc"]


def merge_into_partitions(new_rows: DataFrame, path: str, table: str, keys: list[str],
                          period: str | None = None, order_col: str = ORDER_COL, patch: bool = False) -> int:
    """:func:`merge_touched`, returning the rows written."""
    return merge_touched(new_rows, path, table, keys, period, order_col, patch)[0]


def merge_touched(new_rows: DataFrame, path: str, table: str, keys: list[str], period: str | None = None,
                  order_col: str = ORDER_COL, patch: bool = False) -> tuple[int, list, str]:
    """Upsert ``new_rows`` (with an ``order_col``) into the table at ``path``.

    The row landed last wins, also against stored rows, whose ``order_col`` is
    kept in the table (rows without one, of a full build, are oldest). With
    ``patch`` this holds for each column, so a NULL never replaces a value.
    Rows with a NULL key have nothing to be merged on: all distinct ones stay.
    ``period`` is that of the stored table; ``date`` for a new one if not given.

    Returns the number of rows written to the touched partitions, their period values and the period.
    """
    spark = new_rows.sparkSession
    stored = stored_period(spark, path)
    if stored and period and stored != period:
        raise ValueError(f"{path} is partitioned by {stored}, not by {period}")
    period = stored or period or "date"
    pcol = partition_column(table, period)
    new = kept_aside(with_period(new_rows.withColumn(order_col, F.col(order_col).cast("long")), table, period), table)
    # The periods in a batch are few (a day's load touches one or two): only
    # those partition folders of the existing table are read and replaced.
    touched = [r[0] for r in new.select(pcol).distinct().collect()]
    schema = new.schema
    existing = read_partitions(spark, path, pcol, touched, schema)
    if existing is not None:
        old = existing.withColumn(order_col, F.coalesce(order_col, F.lit(-1).cast("long")))
        both = old.unionByName(new.select(*old.columns))
    else:
        both = new
    keyed = F.lit(True)
    for k in keys:
        keyed = keyed & F.col(k).isNotNull()
    # one aggregate for both: rows without a whole key are told apart by all their columns
    both = both.withColumn(WHOLE, F.when(~keyed, F.struct(*[F.col(f"`{c}`") for c in both.columns])))
    by = [pcol, *keys, WHOLE]
    # Few keys repeat, so an aggregate before the shuffle would sort every row for nothing: dealt by key first,
    # the rows are sorted once, for the aggregate and for the writer (which needs the period to lead). The keys
    # spread a batch's one or two periods over the tasks.
    dealt = both.repartition(*by)
    merged = (_patched(dealt, by, order_col) if patch else dedupe_latest(dealt, by, order_col)).drop(WHOLE)
    obs = Observation("merged_rows")
    (merged.sortWithinPartitions(pcol, *keys)
     .observe(obs, F.count(F.lit(1)).alias("rows"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(pcol).parquet(path))
    return int(obs.get["rows"]), touched, period


def stored_period(spark: SparkSession, path: str) -> str | None:
    """The period of an existing table's partition folders; None if there are none."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hadoop):
        return None
    names = {str(s.getPath().getName()).partition("=")[0] for s in fs.listStatus(hadoop)}
    return next((c.removeprefix("p_") for c in ("p_date", "p_month", "p_year") if c in names), None)


def _patched(rows: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """One row per key: of every other column the value that is not NULL and landed last."""
    others = [c for c in rows.columns if c not in keys and c != order_col]
    latest = [F.max_by(F.col(f"`{c}`"), F.when(F.col(f"`{c}`").isNotNull(), F.col(order_col))).alias(c) for c in others]
    return rows.groupBy(*keys).agg(*latest, F.max(order_col).alias(order_col)).select(*[f"`{c}`" for c in rows.columns])


def weather_batch_rows(docs: DataFrame) -> DataFrame:
    """Landed documents (with ``_landed_at``) -> raw_weather rows + ``_landed_at``."""
    return with_city_attributes(weather_rows(docs, keep=(ORDER_COL,)), keep=(ORDER_COL,))


def load_weather_files(spark: SparkSession, landing_path: str, table_path: str, period: str | None = None,
                       multi_line: bool | None = None, rejects: str | None = None) -> int:
    """Batch form of the refresh: merge the files at ``landing_path`` now.

    Each file is one response object or JSON lines; ``multi_line=False`` says
    that all are JSON lines, which lets large files be split. A bad response
    fails the load, or goes to the ``rejects`` table if one is named.
    """
    if rejects:
        return _load_judged(spark, "weather", landing_path, table_path, period, rejects, multi_line is False)
    docs = _weather_docs(spark.read, landing_path, multi_line)
    return merge_into_partitions(weather_batch_rows(docs), table_path, "raw_weather", WEATHER_KEYS, period)


def _load_judged(spark: SparkSession, feed: str, landing_path: str, table_path: str, period: str | None,
                 rejects: str, by_line: bool = True) -> int:
    """Bad responses to the rejects table, then the good ones merged; returns the rows written by the merge."""
    _, rows, table, keys = _feed(feed)
    found = judged_once(read_judged(spark.read, landing_path, feed, ORDER_COL, by_line))
    store_rejects(found, rejects, feed, ORDER_COL)
    return merge_into_partitions(rows(good(found, (ORDER_COL,))), table_path, table, keys, period,
                                 patch=feed == "generation")


def _weather_docs(reader, path: str, multi_line: bool | None) -> DataFrame:
    if multi_line is False:
        return reader.schema(S.WEATHER_LANDING).option("mode", "FAILFAST").json(path).select("*", _landed_at())
    texts = reader.text(path, wholetext=True).select("value", _landed_at())
    return json_documents(texts, S.WEATHER_LANDING, keep=(ORDER_COL,))


def _landed_at():
    return F.unix_micros(F.col("_metadata.file_modification_time")).alias(ORDER_COL)


def _feed(feed: str):
    """(landing schema, rows builder, raw table, merge keys, JSON options) of a feed."""
    if feed == "weather":
        return S.WEATHER_LANDING, weather_batch_rows, "raw_weather", WEATHER_KEYS
    if feed == "prices":
        return PRICE_LANDING, lambda d: price_rows(d, keep=(ORDER_COL,)), "raw_prices", MARKET_KEYS
    if feed == "generation":
        return GENERATION_LANDING, lambda d: generation_rows(d, keep=(ORDER_COL,)), "raw_generation", MARKET_KEYS
    raise ValueError(f"unknown feed {feed!r}")


def start_refresh(spark: SparkSession, feed: str, landing_dir: str, table_path: str, checkpoint_location: str,
                  period: str | None = None, available_now: bool = True, multi_line: bool | None = None,
                  warehouse: str | None = None, new_stations: str = "renumber",
                  rejects: str | None = None) -> StreamingQuery:
    """Start the refresh stream of one feed (weather, prices or generation).

    New files in ``landing_dir`` are read as they land; each micro-batch is
    merged with :func:`merge_into_partitions`. With ``available_now`` the
    query processes what has landed and stops (a scheduled daily run).
    Weather files are JSON documents or JSON lines, market feeds JSON lines.
    With ``warehouse`` (whose raw table ``table_path`` then is) every batch's
    periods go on to the cleaned and star tables
    (:func:`hourmart.streaming.propagate.refresh_dependants`).
    A bad response stops the stream, unless a ``rejects`` table is named: it
    goes there with its reason and the stream goes on
    (:mod:`hourmart.sources.rejects`).
    """
    schema, rows, table, keys = _feed(feed)
    if rejects:
        docs = read_judged(spark.readStream, landing_dir, feed, ORDER_COL, feed != "weather" or multi_line is False)
    elif feed == "weather":
        docs = _weather_docs(spark.readStream, landing_dir, multi_line)
    else:
        docs = spark.readStream.schema(schema).option("mode", "FAILFAST").json(landing_dir).select("*", _landed_at())

    def upsert(batch: DataFrame, epoch_id: int) -> None:
        if rejects:
            batch = judged_once(batch)
            store_rejects(batch, rejects, feed, ORDER_COL)
            batch = good(batch, (ORDER_COL,))
        _, touched, by = merge_touched(rows(batch), table_path, table, keys, period, patch=feed == "generation")
        if warehouse:
            refresh_dependants(batch.sparkSession, warehouse, table, touched, by, new_stations)

    w = docs.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint_location)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 hour")
    return w.start()


def start_weather_refresh(spark: SparkSession, landing_dir: str, table_path: str, checkpoint_location: str,
                          period: str | None = None, available_now: bool = True,
                          multi_line: bool | None = None) -> StreamingQuery:
    """The weather feed's refresh stream (see :func:`start_refresh`)."""
    return start_refresh(spark, "weather", landing_dir, table_path, checkpoint_location, period, available_now,
                         multi_line)


def default_checkpoint(spark: SparkSession, name: str) -> str:
    from hourmart.session import shared_dir

    return os.path.join(shared_dir(spark), "hourmart-streams", name)


def _market_reader(spark: SparkSession, schema):
    return spark.read.schema(schema).option("mode", "FAILFAST")


def load_price_files(spark: SparkSession, landing_path: str, table_path: str, period: str | None = None,
                     rejects: str | None = None) -> int:
    """Merge landed day-ahead prices (JSON lines of ``timestamp_utc``, ``price``)
    into a raw_prices table partitioned by local period. The stored table
    keeps ``timestamp_utc`` next to the raw columns (the merge key).
    A bad line fails the load, or goes to the ``rejects`` table if one is named."""
    if rejects:
        return _load_judged(spark, "prices", landing_path, table_path, period, rejects)
    lines = _market_reader(spark, PRICE_LANDING).json(landing_path).select("*", _landed_at())
    return merge_into_partitions(price_rows(lines, keep=(ORDER_COL,)), table_path, "raw_prices", MARKET_KEYS, period)


def load_generation_files(spark: SparkSession, landing_path: str, table_path: str, period: str | None = None,
                          rejects: str | None = None) -> int:
    """Merge landed generation (JSON lines of ``timestamp_utc``, ``source``,
    ``mw``) into a raw_generation table, source by source: a file may hold any
    of the sources of the hours it covers.
    A bad line fails the load, or goes to the ``rejects`` table if one is named."""
    if rejects:
        return _load_judged(spark, "generation", landing_path, table_path, period, rejects)
    lines = _market_reader(spark, GENERATION_LANDING).json(landing_path).select("*", _landed_at())
    return merge_into_partitions(generation_rows(lines, keep=(ORDER_COL,)), table_path, "raw_generation",
                                 MARKET_KEYS, period, patch=True)
