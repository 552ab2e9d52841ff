"""Table and delimited-text writers.

Writes are distributed (one file set per task) and committed per job; errors
propagate to the caller instead of leaving a silently empty table behind.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playstats.schemas import ddl
from playstats.sources.delimited import CSV_NULL, NULL_TOKEN, escape


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Map frame columns to table columns by position (load-by-position),
    casting to the table types."""
    if len(df.columns) != len(schema.fields):
        raise ValueError(f"{len(df.columns)} columns for a {len(schema.fields)}-column table")
    return df.select(*[F.col(f"`{c}`").cast(f.dataType).alias(f.name)
                       for c, f in zip(df.columns, schema.fields)])


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: Sequence[str] | None = None, fmt: str = "parquet",
                max_records_per_file: int | None = None) -> str:
    w = df.write.mode(mode).format(fmt)
    if fmt in ("json", "csv"):  # text formats default to millisecond timestamps
        w = (w.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
             .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.save(path)
    return path


def write_tsv(df: DataFrame, path: str, sep: str = "\t", null_token: str | None = NULL_TOKEN,
              mode: str = "overwrite") -> str:
    """Headerless delimited text. Line breaks and backslashes are escaped, text
    with the separator or a quote is quoted (``"`` doubled inside), NULL becomes
    the null token, an empty string stays an empty (quoted) field. Text equal to
    the token reads back as NULL."""
    return _write(df, path, sep, null_token, mode)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Comma-separated variant of :func:`write_tsv` whose NULL mark no text can equal."""
    return _write(df, path, ",", CSV_NULL, mode)


def _write(df: DataFrame, path: str, sep: str, null: str | None, mode: str) -> str:
    cells = [escape(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType)
             else F.col(f"`{f.name}`") for f in df.schema.fields]
    w = (df.select(*cells).write.mode(mode).option("sep", sep).option("header", "false")
         .option("quote", '"').option("escape", '"')
         .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false"))
    if null is not None:
        w = w.option("nullValue", null)
    w.csv(path)
    return path


def save_bucketed_table(df: DataFrame, table: str, key: str, buckets: int, path: str,
                        mode: str = "overwrite") -> str:
    """Store ``df`` as a catalog table hashed into ``buckets`` files by ``key``
    and sorted within each, so joins and aggregations on ``key`` between tables
    with the same bucket count read co-located data and skip the shuffle.
    The frame is first hash-partitioned the same way, so every task writes one
    file per bucket instead of one per bucket and input split."""
    (df.repartition(buckets, key).write.mode(mode).format("parquet")
     .bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table))
    return table


def create_table(spark: SparkSession, name: str, schema: T.StructType, location: str) -> None:
    """``CREATE TABLE IF NOT EXISTS`` as an external Parquet table."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl(schema)}) USING parquet "
              f"LOCATION '{location}'")


def insert_rows(spark: SparkSession, table: str, rows: DataFrame) -> None:
    """Append rows (a DataFrame of any size) to a catalog table, mapping columns
    by position."""
    target = spark.table(table).schema
    conform(rows, target).write.insertInto(table)
