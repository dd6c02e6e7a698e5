"""WARC archives: write, and read back by boundary-chain verification (operator 7).

Writing: equal payloads of at least ``min_bytes`` become one ``response``
record (the largest page id) and ``revisit`` records that name it. Records are
written by Spark's own text sink, so any file system and its commit protocol
serve.

Reading: a file is cut at every place where the record magic stands, in splits
of any size. Such a place is only a candidate: a payload may hold the magic
too. Each task emits candidate -> successor offsets (from Content-Length), and
a record is real only if the chain from the file's start reaches it. Chains
are followed inside segments of a file in one pass, and between segments by
pointer jumping, which takes log2(segments of the largest file) joins over one
row per segment entry. Candidates off the chain are payload bytes, and are
joined back to their record when it spans them.

* null payload: empty; null url or page id: header left out, null on reading.
* empty table: no files, no rows. Repeated rows: one record each; copies of
  the largest page id are all responses.
* extra columns of ``pages`` are not archived.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hourmart.llm.common import sized_broadcast, store

MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
#: Chains are followed in one task inside so many bytes of a file.
SEGMENT_BYTES = 4 << 20


def _header(name: str, value: Column) -> Column:
    """A header line, or nothing for null. Control characters and blanks can't stand in a value."""
    clean = F.regexp_replace(value.cast("string"), r"[\x00-\x20\x7F]", "%20")
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit("\r\n")), F.lit(""))


def write_warc(pages: DataFrame, path: str, min_bytes: int = 1000,
               date: str = "2024-01-01T00:00:00Z") -> None:
    """Write a record for each row of ``pages`` (page_id, url, html) under ``path``."""
    body = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", body.alias("html"), F.sha1(body.cast("binary")).alias("digest"),
                        F.octet_length(body).cast("long").alias("n_bytes"))
    copies = store(rows.where(F.col("n_bytes") >= min_bytes).groupBy("digest", "n_bytes")
                   .agg(F.count("*").alias("n"), F.max("page_id").alias("owner"))
                   .where((F.col("n") > 1) & F.col("owner").isNotNull()).select("digest", "n_bytes", "owner"),
                   "warc-copies")
    rows = rows.join(sized_broadcast(copies), ["digest", "n_bytes"], "left")
    revisit = F.col("owner").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("owner"))

    def record_id(page: Column) -> Column:
        h = F.md5(F.concat_ws(":", F.lit("page"), page.cast("string"), F.col("digest")).cast("binary"))
        return F.concat(F.lit("<urn:uuid:"), F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-"),
                        F.substring(h, 13, 4), F.lit("-"), F.substring(h, 17, 4), F.lit("-"),
                        F.substring(h, 21, 12), F.lit(">"))

    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("n_bytes").cast("string"), F.lit(END))
    content = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))
    record = F.concat(
        F.lit(MAGIC),
        _header("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _header("WARC-Record-ID", record_id(F.col("page_id"))),
        _header("WARC-Date", F.lit(date)),
        _header("WARC-Target-URI", F.col("url")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _header("WARC-Refers-To", F.when(revisit, record_id(F.col("owner")))),
        _header("X-Refers-To-Page", F.when(revisit, F.col("owner"))),
        _header("X-Payload-Bytes", F.col("n_bytes")),
        _header("X-Page-Id", F.col("page_id")),
        F.lit("Content-Type: application/http;msgtype=response\r\nContent-Length: "),
        F.octet_length(content).cast("string"), F.lit(END), content, F.lit("\r\n\r"))
    # the sink adds the record's last line feed
    rows.select(record.alias("value")).write.option("lineSep", "\n").text(path)


def _field(head: Column, name: str, value: str = r"[^\r\n]*") -> Column:
    """The value of a header line, null where it is missing or has another form."""
    return F.get(F.regexp_extract_all(head, F.lit(rf"(?i)(?:^|\r\n){name}: ({value})(?=\r\n|$)"), F.lit(1)), F.lit(0))


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, seq, size, record, chunk): what stands between two places of the magic.

    ``seq`` rises in file order within each split of a file. ``record`` is the whole record's size where
    a record can start. The stored rows keep split and ``seq`` as they were read, so a later read does
    not depend on how many executors are left.
    """
    rows = spark.read.schema("value string").option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("seq"), F.col("value").alias("chunk"))
    head = F.substring_index("chunk", END, 1)
    length = _field(head, "content-length", "[0-9]{1,15}").cast("long")
    able = F.contains("chunk", F.lit(END)) & _field(head, "warc-type").isNotNull()
    return store(rows.select(
        "file", "split", "seq", (F.octet_length("chunk") + F.lit(len(MAGIC))).cast("long").alias("size"),
        F.when(able, F.lit(len(MAGIC) + 8) + F.octet_length(head) + length).alias("record"), "chunk"), "warc-chunks", "zstd")


def _exits(pdf: pd.DataFrame) -> pd.DataFrame:
    """For each candidate of a segment, where its chain first leaves the segment's candidates."""
    pdf = pdf.sort_values("at", ascending=False)
    known: dict[int, int] = {}
    for at, then in zip(pdf["at"], pdf["then"]):
        known[at] = known.get(then, then)
    return pd.DataFrame({"file": pdf["file"], "at": pdf["at"], "exit": [known[a] for a in pdf["at"]]})


def _walk(key: tuple, candidates: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
    """The candidates of a segment that its entries' chains visit."""
    then = dict(zip(candidates["at"], candidates["then"]))
    found = set()
    for at in entries["at"]:
        while at in then and at not in found:
            found.add(at)
            at = then[at]
    return candidates[candidates["at"].isin(found)][["file", "at", "then"]]


def verified_records(candidates: DataFrame, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """(file, at, then) of the candidates on the chain from offset 0 of their file."""
    spark = candidates.sparkSession
    nodes = candidates.withColumn("segment", F.expr(f"at div {segment_bytes}"))
    segments = (nodes.agg(F.max("segment")).first()[0] or 0) + 1
    start = candidates.where(F.col("at") == 0).select("file", "at")
    if segments > 1:
        exits = store(nodes.groupBy("file", "segment").applyInPandas(_exits, "file string, at long, exit long"),
                      "warc-exits")
        entry = exits.select("file", F.col("exit").alias("at")).union(start).distinct()
        jump = store(exits.join(entry, ["file", "at"], "left_semi"), "warc-jump")  # one row per segment entry
        reached = start
        for _ in range((segments - 1).bit_length()):
            reached = store(reached.union(
                reached.join(jump, ["file", "at"]).select("file", F.col("exit").alias("at"))).distinct(), "warc-reached")
            jump = store(jump.join(jump.select("file", F.col("at").alias("exit"), F.col("exit").alias("far")),
                                   ["file", "exit"]).select("file", "at", F.col("far").alias("exit")), "warc-jump")
        start = reached
    entries = start.withColumn("segment", F.expr(f"at div {segment_bytes}"))
    return nodes.groupBy("file", "segment").cogroup(entries.groupBy("file", "segment")) \
        .applyInPandas(_walk, "file string, at long, then long")


def _records(chunks: DataFrame) -> DataFrame:
    """(file, chunk) of whole records -> their fields."""
    raw = F.col("chunk").cast("binary")
    rows = chunks.select("file", raw.alias("raw"), F.substring_index("chunk", END, 1).alias("head"))
    block = F.substring("raw", F.octet_length("head") + F.lit(5), _field(F.col("head"), "content-length").cast("int"))
    rows = rows.select("file", "head", block.alias("block"), _field(F.col("head"), "warc-type").alias("record_type"))
    http = F.octet_length(F.substring_index(F.col("block").cast("string"), END, 1))
    return rows.select(
        "file", _field(F.col("head"), "x-page-id", "-?[0-9]{1,19}").cast("long").alias("page_id"), "record_type",
        _field(F.col("head"), "warc-target-uri").alias("url"),
        _field(F.col("head"), "x-refers-to-page", "-?[0-9]{1,19}").cast("long").alias("refers_to"),
        F.when(F.col("record_type") != "revisit", F.substring("block", http + F.lit(5), F.octet_length("block")))
        .alias("payload"),
        _field(F.col("head"), "warc-payload-digest", "sha1:[0-9a-f]*").substr(F.lit(6), F.lit(40)).alias("header_digest"),
        _field(F.col("head"), "x-payload-bytes", "[0-9]{1,15}").cast("long").alias("header_bytes"))


def read_warc(spark: SparkSession, path: str, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """The real records under ``path``: file, page_id, record_type, url, refers_to, payload (null for a
    revisit), header_digest and header_bytes (the payload's digest and size as the header states them)."""
    found = _chunks(spark, path)
    # narrow rows from here on; a window holds one split, or one row per split of a file
    before = Window.partitionBy("file", "split").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    local = F.coalesce(F.sum("size").over(before), F.lit(0))
    splits = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    base = (found.groupBy("file", "split").agg(F.sum("size").alias("bytes"))
            .select("file", "split", F.coalesce(F.sum("bytes").over(splits), F.lit(0)).alias("base")))
    place = store(found.select("file", "split", "seq", "size", "record", local.alias("local")).join(base, ["file", "split"])
                  .select("file", "seq", "size", "record",
                          (F.col("base") + F.col("local") - F.lit(len(MAGIC))).alias("at")), "warc-places") \
        .where(F.col("at") >= 0)
    candidates = place.where(F.col("record").isNotNull()).select("file", "at", (F.col("at") + F.col("record")).alias("then"))
    real = store(verified_records(candidates, segment_bytes), "warc-real")

    # chunks that are not one whole record: rejected candidates, and records that span several chunks
    odd = store(place.join(real, ["file", "at"], "left").where(
        F.col("then").isNull() | (F.col("then") > F.col("at") + F.col("size"))), "warc-odd")
    n_odd = odd.count()
    able = found.where(F.col("record").isNotNull())  # all else is inside payloads, or before a file's first magic
    if not n_odd:
        return _records(able)
    single = able.join(sized_broadcast(odd.select("seq"), n_odd), "seq", "left_anti")
    # a span's chunks lie between its start and its end: the last start at or before each chunk is its record
    upto = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    owner = odd.select("seq", "at", "file", F.last(F.when(F.col("then").isNotNull(), F.col("at")), True).over(upto).alias("own"),
                       F.last("then", True).over(upto).alias("end")).where(F.col("at") < F.col("end"))
    spans = (found.select("seq", "chunk").join(sized_broadcast(owner.select("seq", "at", "file", "own"), n_odd), "seq")
             .groupBy("file", "own").agg(F.array_sort(F.collect_list(F.struct("at", "chunk"))).alias("parts"))
             .select("file", F.array_join(F.col("parts.chunk"), MAGIC).alias("chunk")))
    return _records(single.select("file", "chunk").unionByName(spans))


def payload_summary(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to: of the payload that was read,
    or for a revisit, of the one its header names."""
    return records.select(
        "page_id",
        F.coalesce(F.octet_length("payload").cast("long"), F.col("header_bytes")).alias("payload_bytes"),
        F.coalesce(F.sha1("payload"), F.col("header_digest")).alias("payload_digest"),
        "record_type", "refers_to")
