"""Row-level changes on Parquet tables: upsert, insert-if-absent, delete.

Each operation is a pure DataFrame function (old table + change set -> new
table), so its logic is testable without storage. ``replace_contents`` stores
a result as a new table and swaps the names: Parquet tables refuse MERGE, DELETE
and overwriting a table that is being read.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playstats.operators.keys import keep_first
from playstats.scratch import scratch_path


def _ordering(batch: DataFrame, order_by: Sequence[str]) -> Column:
    rest = [c for c in batch.columns if c not in order_by]
    return F.struct(*[F.col(f"`{c}`") for c in list(order_by) + rest])


def _known(batch: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows with a key, rows whose key is NULL)."""
    return batch.filter(F.col(key).isNotNull()), batch.filter(F.col(key).isNull())


def upsert(target: DataFrame, batch: DataFrame, key: str, update_cols: Sequence[str],
           order_by: Sequence[str]) -> DataFrame:
    """``INSERT ... ON CONFLICT (key) DO UPDATE SET <update_cols> = EXCLUDED...``
    applied row by row in ``order_by`` order.

    Existing keys keep every stored column except ``update_cols``, which take
    the batch's last value; new keys take the first batch row's other columns
    and the last row's ``update_cols``. The batch is reduced per key with
    min_by/max_by (partial aggregation, so a hot key shrinks before the
    shuffle); then one full outer join with the target.

    A batch row whose key is NULL never conflicts: each one stays a row of its
    own, and the primary-key check (``operators.quality``) reports it.
    """
    cols = target.columns
    keep_cols = [c for c in cols if c != key and c not in update_cols]
    known, unknown = _known(batch, key)
    ordering = _ordering(batch, order_by)
    b = known.groupBy(key).agg(
        F.min_by(F.struct(*[F.col(f"`{c}`") for c in keep_cols] or [F.lit(None)]), ordering).alias("_first"),
        F.max_by(F.struct(*[F.col(f"`{c}`") for c in update_cols]), ordering).alias("_last"),
        F.lit(True).alias("_in_b"))
    t = target.withColumn("_in_t", F.lit(True))
    j = t.join(b, key, "full_outer")
    out = []
    for c in cols:
        if c == key:
            out.append(F.col(key))
        elif c in update_cols:
            out.append(F.when(F.col("_in_b"), F.col("_last").getField(c)).otherwise(t[c]).alias(c))
        else:
            out.append(F.when(F.col("_in_t"), t[c]).otherwise(F.col("_first").getField(c)).alias(c))
    return j.select(*out).unionByName(unknown.select(*cols))


def insert_if_absent(target: DataFrame, batch: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """``ON CONFLICT DO NOTHING``: keys already stored are left alone; a new key
    repeated in the batch is inserted once, from its first row. Rows whose key is
    NULL never conflict and are all inserted."""
    return target.unionByName(new_rows_if_absent(target, batch, key, order_by))


def new_rows_if_absent(target: DataFrame, batch: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """The rows ``ON CONFLICT DO NOTHING`` would add: the first batch row of
    every key the target does not hold, and every row without a key."""
    known, unknown = _known(batch, key)
    first = keep_first(known, [key], list(order_by)).select(*target.columns)
    return first.join(target.select(key), key, "left_anti").select(*target.columns).unionByName(
        unknown.select(*target.columns))


def append_if_absent(spark: SparkSession, table: str, batch: DataFrame, key: str,
                     order_by: Sequence[str]) -> None:
    """Store an insert-if-absent by appending only the new keys' rows. Stored
    rows never change under DO NOTHING, so nothing is rewritten."""
    target = spark.table(table)
    new_rows_if_absent(target, batch, key, order_by).write.insertInto(table)


def delete_by_key(target: DataFrame, key: str, keys: DataFrame | object) -> DataFrame:
    """``DELETE WHERE key = k`` for one value or for every value of a one-column
    DataFrame. Rows whose key is NULL never match and stay."""
    if isinstance(keys, DataFrame):
        k = keys.select(F.col(keys.columns[0]).alias("_del_key")).dropDuplicates()
        return target.join(k, target[key] == k["_del_key"], "left_anti")
    return target.filter(~F.col(key).eqNullSafe(F.lit(keys)))


def table_layout(spark: SparkSession, table: str) -> tuple[list[str], list[str], int, list[str]]:
    """(partition columns, bucket columns, number of buckets, sort columns) of a
    catalog table."""
    columns = spark.catalog.listColumns(table)
    partitions = [c.name for c in columns if c.isPartition]
    facts = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    if not facts.get("Num Buckets"):
        return partitions, [], 0, []

    def names(fact: str) -> list[str]:
        return [n.strip().strip("`") for n in facts.get(fact, "[]").strip("[]").split(",") if n.strip()]

    return partitions, names("Bucket Columns"), int(facts["Num Buckets"]), names("Sort Columns")


def replace_contents(spark: SparkSession, table: str, new_contents: DataFrame,
                     location: str | None = None) -> str:
    """Store ``new_contents`` as a new table of the same layout (partitions,
    buckets, sort order) at a fresh location, then swap the names. Readers of the
    old files are not disturbed while the new ones are written."""
    location = location or scratch_path(spark, f"table-{table.replace('.', '_')}")
    partitions, bucket_cols, buckets, sort_cols = table_layout(spark, table)
    new, old = (f"{table}_{kind}_{uuid.uuid4().hex[:8]}" for kind in ("new", "old"))
    rows = new_contents.select(*[f"`{c}`" for c in spark.table(table).columns])
    if buckets:
        rows = rows.repartition(buckets, *bucket_cols)
    writer = rows.write.mode("errorifexists").format("parquet").option("path", location)
    if partitions:
        writer = writer.partitionBy(*partitions)
    if buckets:
        writer = writer.bucketBy(buckets, *bucket_cols)
        if sort_cols:
            writer = writer.sortBy(*sort_cols)
    writer.saveAsTable(new)
    spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {new} RENAME TO {table}")
    spark.sql(f"DROP TABLE {old}")
    spark.catalog.refreshTable(table)
    return location
