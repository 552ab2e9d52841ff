"""Shared scratch storage for staging tables.

The folder is whatever the session names in ``spark.checkpoint.dir`` (HDFS, S3,
...), so driver and executors reach it alike. A local session that names none
uses a folder below its warehouse directory; a cluster session must name one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder under the shared root."""
    return f"{checkpoint_root(spark)}/playstats/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as Parquet to a scratch folder and read again. It can
    be scanned many times with column pruning, and a lost executor recomputes
    nothing that came before."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
