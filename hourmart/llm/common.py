"""Shared helpers: the scratch folder all executors see, text columns, size-checked joins."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourmart.session import shared_dir

#: A side is sent whole to every executor only when it has at most this many (narrow) rows.
BROADCAST_ROWS = 500_000

#: Bits of the filter that ``likely_rows`` sends to every executor: 4 MB, whatever the number of keys.
FILTER_BITS = 1 << 25

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ship(spark: SparkSession) -> None:
    """Give this package to the executors' Python workers, once per application.

    Needed where it is not installed on them; a job started with ``--py-files`` has it twice, which is harmless.
    """
    sc = spark.sparkContext
    if getattr(sc, "_hourmart_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="hourmart-code-"), "hourmart_code.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    sc.addPyFile(archive)
    sc._hourmart_shipped = True


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name under the cluster's shared folder (``spark.checkpoint.dir``).

    Where that setting is missing, a local session takes a temporary folder
    and any other session one beside its warehouse, which is shared too.
    """
    if spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir():
        base = shared_dir(spark)
    elif spark.sparkContext.master.split("[")[0] == "local":
        base = shared_dir(spark, tempfile.mkdtemp(prefix="hourmart-shared-"))
    else:
        base = shared_dir(spark, spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage,
    and a lost executor costs a re-read instead of a recomputation.
    ``compression``: for tables that hold whole texts; else the session's."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else. For pure ASCII, ``lower`` is the same and faster."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)) \
        .otherwise(F.translate(text, UPPER, UPPER.lower()))


def document_key(text: Column) -> Column:
    """Second half of a row key (doc_id, key): rows that agree on both are the same row."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def sized_broadcast(df: DataFrame, rows: int | None = None, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only when the counted rows are within ``limit``; else leave the join to shuffle.

    ``df`` must hold a few fixed-width columns. Give ``rows`` if they are counted already.
    """
    n = df.limit(limit + 1).count() if rows is None else rows
    return F.broadcast(df) if n <= limit else df


def likely_rows(df: DataFrame, keys: DataFrame, on: list[str], bits: int | None = None) -> DataFrame:
    """The rows of ``df`` whose ``on`` columns are in ``keys``, and those few whose hash meets one of a key.

    For an exact join afterwards, which then need not shuffle all of ``df``. Only bitmaps of ``bits`` bits in all
    pass through the driver, so its memory does not grow with ``keys``; with more than a tenth as many keys as
    bits, more rows get through, which costs time and never a row. ``on`` is in both and ``keys`` has no null.
    """
    place = F.pmod(F.xxhash64(*on), F.lit(bits or FILTER_BITS))
    bitmap, bit = F.shiftright(place, 15), place.bitwiseAND(F.lit((1 << 15) - 1))  # as bitmap_construct_agg cuts them
    found = keys.select(bitmap.alias("_bitmap"), bit.alias("_bit")).repartition("_bitmap") \
        .groupBy("_bitmap").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    byte = F.conv(F.hex(F.substring("_bits", F.shiftright(bit, 3).cast("int") + F.lit(1), F.lit(1))), 16, 10).cast("int")
    is_set = F.getbit(byte, bit.bitwiseAND(F.lit(7)).cast("int")) == F.lit(1)
    return df.join(F.broadcast(found), (bitmap == F.col("_bitmap")) & is_set, "left_semi")
