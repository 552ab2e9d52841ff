"""Constraints of a batch against stored tables, at the cost of the batch.

The whole-table checks of ``operators.quality`` read every key. Here a batch is checked
before it is stored: its keys are looked up in the key filters of the buckets that they
fall into (``Layout(filters=True)``), and only buckets in which a filter found
something are opened to confirm it. A filter refuses no key that is stored, so what it
refuses needs no look at the table.
"""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playstats.operators.bloom import probable
from playstats.operators.quality import QualityError, primary_key_violations
from playstats.scratch import stored
from playstats.sinks.versioned import BUCKET, VersionedTables


def stored_keys(store: VersionedTables, name: str, keys: DataFrame) -> DataFrame:
    """(key): those of the one-column frame's distinct keys that the table holds."""
    stage = store.stage()
    entry, field = stage.entry(name), stage._key(name)
    if entry["filters"] is None:
        raise ValueError(f"{name} was published without key filters")
    keys = stored(keys.select(F.col(f"`{keys.columns[0]}`").cast(field.dataType).alias(field.name)).dropna().distinct(), "checked-keys")
    own = stored(keys.select(F.col(f"`{field.name}`").alias("key"), stage._bucket(name).alias(BUCKET)), "checked-buckets")
    touched = [b for b in sorted(str(r[0]) for r in own.select(BUCKET).distinct().collect()) if b in entry["filters"]]
    paths = [store._path(p) for b in touched for p in entry["filters"][b]]
    if not paths:
        return keys.limit(0).select(F.col(f"`{field.name}`").alias("key"))
    # a bucket has a filter for each of its folders
    words = store.spark.read.schema("n_words bigint, i bigint, w bigint").parquet(*paths).select(
        "n_words", "i", "w", F.regexp_extract("_metadata.file_path", r"([^/]+/[^/]+/[^/]+)/[^/]+$", 1).alias("part"))
    words = words.withColumn(BUCKET, F.regexp_extract("part", r"(\d+)$", 1).cast("int"))
    parts = words.select("part", BUCKET).distinct()
    hits = stored(probable(own.join(parts, BUCKET), words, "part"), "checked-hits")
    opened = sorted({str(r[0]) for r in hits.join(own, "key").select(BUCKET).distinct().collect()})
    if not opened:
        return keys.limit(0).select(F.col(f"`{field.name}`").alias("key"))
    rows = store._rows(entry, opened).select(F.col(f"`{field.name}`").alias("key"))
    return hits.select("key").distinct().join(rows, "key", "left_semi")


def batch_key_violations(store: VersionedTables, name: str, batch: DataFrame) -> DataFrame:
    """(key, n_rows): keys that the batch may not add: NULL, twice in the batch, or stored."""
    key = store.manifest()[name]["key"]
    own = batch.select(F.col(f"`{key}`"))
    inside = primary_key_violations(own, [key]).select(F.col(f"`{key}`").alias("key"), "n_rows")
    held = stored_keys(store, name, own)
    again = own.join(held.select(F.col("key").alias(key)), key, "left_semi").groupBy(F.col(f"`{key}`").alias("key")).agg(
        F.count(F.lit(1)).alias("n_rows"))
    return inside.unionByName(again).groupBy("key").agg(F.max("n_rows").alias("n_rows"))


def batch_reference_violations(store: VersionedTables, parent: str, batch: DataFrame, fk: str) -> DataFrame:
    """(key, n_rows): values of the batch's column that the parent table lacks."""
    own = batch.groupBy(F.col(f"`{fk}`").alias("key")).agg(F.count(F.lit(1)).alias("n_rows")).filter("key IS NOT NULL")
    held = stored_keys(store, parent, own.select("key"))
    kind: T.DataType = own.schema["key"].dataType
    return own.join(held.select(F.col("key").cast(kind).alias("key")), "key", "left_anti")


def assert_batch(store: VersionedTables, name: str, batch: DataFrame, references: dict[str, str] | None = None) -> None:
    """Fails unless the batch can be added: new, single, known keys, and for each column of
    ``references`` (column -> parent table) only values that the parent has."""
    for what, bad in [(f"{name}: key", batch_key_violations(store, name, batch)),
                      *[(f"{name}.{c} -> {p}", batch_reference_violations(store, p, batch, c)) for c, p in (references or {}).items()]]:
        if found := bad.take(5):
            raise QualityError(f"{what}: e.g. {[tuple(r) for r in found]}")
