"""Landed responses judged one by one: good ones load, bad ones go to a rejects table with their reason.

The strict readers (:mod:`hourmart.sources.landing`) stop at the first bad
response. Here every response is parsed permissively and gets a ``reason``,
NULL for a good one, by Spark's own functions in the scan's tasks (no shuffle).
A response is taken or rejected whole. Reasons, the first that holds:

* ``not_json``: not one JSON value. A file that is not one JSON document is
  taken line by line, so a cut line rejects itself only; a file of several
  lines without a JSON object among them is one reject.
* ``not_object``: JSON, but no object. ``wrong_type``: a field of another type than declared.
* weather: ``no_city``; ``no_hours`` (no time array; an empty one is a good
  response of no rows); ``bad_time``; ``value_without_time`` (an array longer
  than the times). Shorter arrays and NULL values are good.
* market feeds: ``no_time``, ``bad_time``; generation also ``no_source``.

Blank lines are no responses; a file without text is one reject (``not_json``), unless files are read by line.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourmart import schemas as S
from hourmart.session import kept_aside
from hourmart.sources.landing import GENERATION_LANDING, PRICE_LANDING, is_landing_time, is_utc_instant

CORRUPT = "_corrupt"
REJECTS = T.StructType([T.StructField("feed", T.StringType()), T.StructField("file", T.StringType()),
                        T.StructField("landed_at", T.LongType()), T.StructField("reason", T.StringType()),
                        T.StructField("response", T.StringType())])
SCHEMAS = {"weather": S.WEATHER_LANDING, "prices": PRICE_LANDING, "generation": GENERATION_LANDING}


def _values_beyond_times() -> Column:
    times = F.size("d.hourly.time")
    longer = [F.coalesce(F.size(f"d.hourly.{f.name}"), F.lit(0)) > times
              for f in S.WEATHER_LANDING["hourly"].dataType.fields if f.name != "time"]
    return reduce(lambda a, b: a | b, longer)


def _rules(feed: str) -> list[tuple[str, Column]]:
    """(reason, condition) of a feed's own checks, in order."""
    if feed == "weather":
        return [("no_city", F.col("d.city").isNull()), ("no_hours", F.col("d.hourly.time").isNull()),
                ("bad_time", ~F.forall("d.hourly.time", lambda t: F.coalesce(is_landing_time(t), F.lit(False)))),
                ("value_without_time", _values_beyond_times())]
    rules = [("no_time", F.col("d.timestamp_utc").isNull()), ("bad_time", ~is_utc_instant(F.col("d.timestamp_utc")))]
    return rules + ([("no_source", F.col("d.source").isNull())] if feed == "generation" else [])


def _is_json(text: Column) -> Column:
    """One JSON value and nothing beside it (an object that nothing closes, as of a cut response, needs no parser)."""
    open_ended = F.ltrim(text).startswith("{") & ~F.contains(text, F.lit("}"))
    length = F.when(~open_ended, F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))))
    return F.coalesce(length == 1, F.lit(False))


def responses(files: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Whole files (column ``value``) -> a row per response text in them."""
    lines = F.filter(F.transform(F.split("value", "\n"), F.trim), lambda x: x != "")
    some_object = F.exists(lines, lambda x: x.startswith("{") & _is_json(x))
    parts = F.when(~_is_json(F.col("value")) & (F.size(lines) > 1) & some_object, lines).otherwise(F.array("value"))
    return files.select(*keep, F.explode(parts).alias("value"))


def judged(texts: DataFrame, feed: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Response texts (column ``value``) -> ``d`` (the parsed response), ``reason`` and ``response``, plus ``keep``."""
    schema = T.StructType([*SCHEMAS[feed].fields, T.StructField(CORRUPT, T.StringType())])
    known = texts.select(*keep, F.col("value").alias("response"), _is_json(F.col("value")).alias("_json"))
    # what is no JSON is not parsed again
    parsed = known.select(*keep, "response", "_json", F.from_json(
        F.when(F.col("_json"), F.col("response")), schema, {"columnNameOfCorruptRecord": CORRUPT}).alias("d"))
    checks = [("not_json", ~F.col("_json")),
              ("not_object", ~F.ltrim(F.regexp_replace("response", r"^\s+", "")).startswith("{")),
              ("wrong_type", F.col("d").isNull() | F.col(f"d.{CORRUPT}").isNotNull()), *_rules(feed)]
    reason = F.coalesce(*[F.when(bad, F.lit(name)) for name, bad in checks])
    return parsed.select(*keep, F.col("d").dropFields(CORRUPT).alias("d"), reason.alias("reason"), "response")


def judged_once(rows: DataFrame) -> DataFrame:
    """Judged rows written beside and read from there, so that no later step judges them again.

    A good response's text and a bad one's fields are not needed any more: NULL.
    """
    bad = F.col("reason").isNotNull()
    return kept_aside(rows.withColumns({"response": F.when(bad, F.col("response")), "d": F.when(~bad, F.col("d"))}), "judged")


def good(rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The good responses' fields, as the strict readers give them."""
    return rows.where(F.col("reason").isNull()).select("d.*", *keep)


def read_judged(reader, path: str, feed: str, order_col: str, by_line: bool = False) -> DataFrame:
    """Landed files (``spark.read`` or ``spark.readStream``) judged, with ``file`` and ``order_col`` (landing time).

    ``by_line``: all files are JSON lines, which lets large ones be split.
    """
    keep = ("file", order_col)
    files = reader.text(path, wholetext=not by_line).select(
        "value", F.col("_metadata.file_path").alias("file"),
        F.unix_micros(F.col("_metadata.file_modification_time")).alias(order_col))
    texts = files.where(F.trim("value") != "") if by_line else responses(files, keep)
    return judged(texts, feed, keep)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """The rejects table (empty before its first reject)."""
    try:
        return spark.read.schema(REJECTS).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], REJECTS)


def store_rejects(rows: DataFrame, path: str, feed: str, order_col: str) -> int:
    """Append the bad ones of judged ``rows`` to the rejects table; returns how many are new.

    A file is judged whole in one load or batch and an append is committed whole, so a file (at its landing time)
    that the table knows is not written again: a replayed batch or a repeated load adds nothing.
    """
    bad = rows.where(F.col("reason").isNotNull()).select(
        F.lit(feed).alias("feed"), "file", F.col(order_col).alias("landed_at"), "reason", "response")
    known = read_rejects(rows.sparkSession, path).where(F.col("feed") == feed).select("file", "landed_at").distinct()
    seen = Observation("rejected")
    bad.join(known, ["file", "landed_at"], "left_anti").select(*REJECTS.names) \
        .observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").parquet(path)
    return int(seen.get["n"])
