"""Benchmark: build the warehouse from the driver tables, then run every
registered query over the stored tables.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Prints one JSON line. ``value`` is the sum of the per-query times; the
warehouse build (raw -> cleaned -> star, 11 tables written) and the
end-to-end flagship (driver tables -> answer, nothing stored) and one day's refresh of the raw
weather table are reported separately.

Each query is executed in full with the ``noop`` sink (every row computed,
nothing collected to the driver).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
import uuid

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from hourmart.plans.registry import FLAGSHIP, QUERIES  # noqa: E402
from hourmart.session import get_session, shared_dir  # noqa: E402
from hourmart.sinks.writer import build_warehouse, write_table  # noqa: E402
from hourmart.sources.catalog import DerivedTables, StoredTables  # noqa: E402
from hourmart.sources.landing import to_json_lines, weather_landing_docs  # noqa: E402
from hourmart.streaming.refresh import load_weather_files  # noqa: E402


def run(df) -> float:
    t0 = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def daily_refresh(spark, stored: StoredTables, base: str, day: str = "1995-06-15") -> float:
    """Time one day's load: the stations' responses for ``day`` (JSON lines,
    derived from the stored raw table) merged into a day-partitioned raw
    table that already holds the whole history."""
    raw = stored.table("raw_weather")
    table = f"{base}/refresh/raw_weather"
    write_table(raw, table, "raw_weather", period="date")
    landing = f"{base}/landing/{day}"
    docs = weather_landing_docs(raw.where(F.to_date("timestamp") == F.lit(day).cast("date")))
    to_json_lines(docs).write.mode("overwrite").text(landing)
    t0 = time.perf_counter()
    load_weather_files(spark, landing, table, period="date", multi_line=False)
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    spark = get_session(f"local[{cpus}]", app="hourmart-bench", shuffle_partitions=cpus,
                        conf={"spark.driver.memory": "8g"})
    base = f"{shared_dir(spark, '/tmp/hourmart-checkpoints')}/hourmart-bench-{uuid.uuid4().hex[:8]}"

    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm):
        run(QUERIES[FLAGSHIP](DerivedTables(spark, warm)))  # JVM warm-up, not timed
    e2e = run(QUERIES[FLAGSHIP](DerivedTables(spark, sf_dir)))

    t0 = time.perf_counter()
    counts = build_warehouse(spark, DerivedTables(spark, sf_dir), base)
    build = time.perf_counter() - t0

    stored = StoredTables(spark, base)
    times: dict[str, float] = {}
    for key, fn in QUERIES.items():
        times[key] = round(run(fn(stored)), 3)

    refresh = daily_refresh(spark, stored, base)

    out = {
        "metric": "sum_query_sec_over_stored_warehouse",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf,
        "build_warehouse_sec": round(build, 3),
        "e2e_flagship_from_driver_tables_sec": round(e2e, 3),
        "daily_refresh_sec": round(refresh, 3),
        "rows_written": counts,
        "cpus": cpus,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
