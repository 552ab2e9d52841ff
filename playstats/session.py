"""SparkSession factory for own runs and tests.

Library functions never depend on these settings: they work under any session
time zone, ANSI mode and partition count the caller chooses.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def get_spark(app_name: str = "playstats", cpus: int | str | None = None,
              shuffle_partitions: int | None = None) -> SparkSession:
    cpus = cpus or os.environ.get("BENCH_CPUS", "*")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("PLAYSTATS_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scale_conf(input_bytes: int, total_cores: int, split_bytes: int = 1 << 30,
               advisory_bytes: int = 256 << 20, max_shuffle_partitions: int | None = None) -> dict[str, str]:
    """Session settings sized for a run over ``input_bytes`` on ``total_cores``
    executor cores, for a cluster session's builder (the library never sets
    them itself).

    * Scan splits are ``split_bytes`` (Parquet scans stream row groups, so a
      large split does not mean a large working set). This keeps the map task
      count, and with it the driver's map-output tracking (maps × reducers),
      manageable.
    * The initial shuffle partition count covers the input at one split each,
      with at least three waves per core (``max_shuffle_partitions``: the
      caller's own bound, none by default).
      AQE then coalesces shuffle partitions to ``advisory_bytes`` and splits
      skewed join partitions.
    """
    parts = max(3 * total_cores, -(-input_bytes // split_bytes))
    if max_shuffle_partitions is not None:
        parts = min(parts, max_shuffle_partitions)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(advisory_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }
