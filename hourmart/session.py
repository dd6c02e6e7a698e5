"""SparkSession defaults for hourmart jobs."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every hourmart job relies on. ANSI mode turns silent overflow and
# division by zero into errors (the helpers guard divisions with NULLIF);
# the session zone is pinned so that any zoned conversion is reproducible;
# AQE re-plans joins and partition counts from measured shuffle sizes.
DEFAULTS: dict[str, str] = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
    # NANOS: pandas writes nanosecond times; Spark reads them as long, the raw reader converts them
    "spark.sql.legacy.parquet.nanosAsLong": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "hourmart",
                shuffle_partitions: int | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with :data:`DEFAULTS` plus ``conf``.

    ``master`` is only set when given, so cluster submissions keep theirs.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = dict(DEFAULTS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The cluster's shared folder for checkpoints and written tables.

    Read from ``spark.checkpoint.dir`` (or a checkpoint folder the
    application already set); a ``fallback`` is set only where the session
    names none (local tests). Never a machine-local temp folder on a cluster.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if fallback is None:
            raise RuntimeError("spark.checkpoint.dir is not set and no fallback was given")
        if "://" not in fallback:
            os.makedirs(fallback, exist_ok=True)
        sc.setCheckpointDir(fallback)
        d = fallback
    return d.rstrip("/")


def kept_aside(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a new folder of the shared folder and read from there: what made it runs once."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scale_conf(input_bytes: float, executors: int, cores_per_executor: int,
               target_partition_bytes: int = 256 * 1024 ** 2) -> dict[str, str]:
    """Partition sizing for a cluster run (pass the result as ``conf``).

    * scans split files into ``target_partition_bytes`` pieces;
    * the initial shuffle width gives every shuffle at least one target-sized
      partition per ``target_partition_bytes`` of input (and at least three
      waves of tasks); AQE then merges partitions down to the advisory size
      and splits skewed ones (a key with a third of the rows is cut into
      advisory-sized pieces instead of landing in one task);
    * broadcasting stays behind a measured-size threshold, so a side is only
      broadcast when it is known to be small.
    """
    slots = max(1, executors * cores_per_executor)
    initial = max(3 * slots, int(input_bytes // target_partition_bytes) + 1)
    size = str(target_partition_bytes)
    return {
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 ** 2),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 ** 2),
    }
