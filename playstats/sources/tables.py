"""Full table scans: catalog tables by name, Parquet tables by path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    if "/" in name_or_path or name_or_path.endswith(".parquet"):
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables (``<sf_dir>/<name>.parquet``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored_counts(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """(table_name, n_rows) of Parquet tables, from the footers of their files alone: the
    aggregate is pushed into the scan, which reads no column.

    The session's own settings stay as they are; the scan runs in a sister session with
    the Parquet reader that takes aggregates."""
    sister = spark.newSession()
    v1 = [s for s in sister.conf.get("spark.sql.sources.useV1SourceList").split(",") if s.strip() != "parquet"]
    sister.conf.set("spark.sql.sources.useV1SourceList", ",".join(v1))
    sister.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    # a table without a row group gives no count to add up, so each has a zero besides
    out = sister.createDataFrame([(name, 0) for name in paths], "table_name string, n_rows bigint")
    for name, path in paths.items():
        out = out.unionAll(sister.read.parquet(path).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name), "n_rows"))
    return out.groupBy("table_name").agg(F.sum("n_rows").alias("n_rows"))
