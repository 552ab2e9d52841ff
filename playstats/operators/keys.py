"""Row identity: distinct, keep-last per key, duplicate finders, surrogate ids,
patch by key.

Skew rule for everything here: a single key may hold a large share of all rows,
so per-key work is done with partial (map-side) aggregation before any shuffle,
and rows are re-attached with a join on the (small) key result instead of a
window that would buffer a whole hot group in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playstats.operators.joins import skew_safe_join
from playstats.scratch import stored


def _cols(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def distinct_rows(df: DataFrame) -> DataFrame:
    """Full-row distinct; NULLs compare equal."""
    return df.dropDuplicates()


#: Rows left out of a stored table by name and place; beyond this size they are not broadcast.
DROPPED_BYTES = 64 << 20


def distinct_stored(spark: SparkSession, path: str, dropped_bytes: int = DROPPED_BYTES) -> DataFrame:
    """Full-row distinct of a Parquet table; NULLs compare equal, as do NaNs and both zeros.

    Only a 128-bit digest of each row and its place (file, row number) are shuffled: the
    first place of each digest stays, the others are left out by an anti join on the place
    in a second scan, which moves no row. That needs the places to be few; with more than
    ``dropped_bytes`` of them :func:`distinct_rows` takes over, whose partial aggregate is
    at its best where many rows are equal. Nested columns go that way too, as their digests
    would not tell ``[NULL, 1]`` from ``[1, NULL]``."""
    table = spark.read.parquet(path)
    if any(isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)) for f in table.schema):
        return distinct_rows(table)
    file, row = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    # a hash of values alone skips NULLs, so each value comes with whether it is one
    parts = [x for c in table.columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    digest = [F.xxhash64(F.lit(seed), *parts).alias(f"h{seed}") for seed in (1, 2)]
    places = table.select(*digest, F.struct(file.alias("file"), row.alias("row")).alias("place"))
    repeated = stored(places.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
                      .filter("n > 1"), "repeated-rows")
    size = F.sum((F.col("n") - 1) * (F.length("first.file") + 64))
    if (repeated.agg(size).first()[0] or 0) > dropped_bytes:
        return distinct_rows(table)
    # as many rows as are left out, and one more each: few enough to broadcast as well
    dropped = stored(places.join(F.broadcast(repeated), ["h1", "h2"]).filter(F.col("place") != F.col("first"))
                     .select("place.file", "place.row"), "dropped-rows")
    # by number, so that no name of the table clashes with the place
    numbered = [F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(table.columns)]
    kept = table.select(*numbered, file.alias("file"), row.alias("row")).join(
        F.broadcast(dropped), ["file", "row"], "left_anti")
    return kept.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(table.columns)])


def distinct_projection(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).dropDuplicates()


def _pick_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], last: bool) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).dropDuplicates()
    # order columns first, then every other column as a deterministic tie-break
    tiebreak = list(order_by) + [c for c in rest if c not in order_by]
    value = F.struct(*[F.col(f"`{c}`") for c in rest])
    ordering = F.struct(*[F.col(f"`{c}`") for c in tiebreak])
    pick = F.max_by(value, ordering) if last else F.min_by(value, ordering)
    return (df.groupBy(*keys).agg(pick.alias("_pick"))
            .select(*keys, *[F.col("_pick").getField(c).alias(c) for c in rest]))


def keep_last(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the row that is last by ``order_by`` (then by the
    remaining columns). ``max_by`` aggregates partially before the shuffle, so a
    hot key shrinks to one row per task first."""
    return _pick_per_key(df, keys, order_by, last=True)


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    return _pick_per_key(df, keys, order_by, last=False)


# Rows per chunk when repeated rows are expanded back (bounded array per row).
EXPAND_CHUNK = 1_000_000


def expand_counts(df: DataFrame, count_col: str, chunk: int = EXPAND_CHUNK) -> DataFrame:
    """Repeat every row ``count_col`` times (the column is dropped).

    A row is first split into chunk descriptors of at most ``chunk`` copies.
    The descriptors are hash-spread over tasks, and each task writes its
    chunks out. A row repeated 10^11 times is therefore expanded by many
    tasks, and no array holds more than ``chunk`` elements."""
    cols = [c for c in df.columns if c != count_col]
    n = F.col(count_col).cast("long")
    last = F.floor((n - 1) / F.lit(chunk)).cast("long")
    desc = (df.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), last)))
            .withColumn("_size", F.least(F.lit(chunk).cast("long"), n - F.col("_chunk") * F.lit(chunk))))
    spread = desc.repartition(F.xxhash64(*[F.col(f"`{c}`") for c in cols], F.col("_chunk")))
    return (spread.select(*[F.col(f"`{c}`") for c in cols],
                          F.explode(F.sequence(F.lit(1).cast("long"), F.col("_size"))).alias("_i"))
            .drop("_i"))


def key_counts(df: DataFrame, keys: Sequence[str], name: str = "n_rows") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def groups_larger_than(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """All rows whose key group has more than ``n`` rows (NULL keys form a
    group), with their multiplicity.

    Skew-proof even when one key, or one repeated row, holds a third of the
    data:
    1. rows are reduced to (row, copies) by a partial aggregate and stored once;
    2. key sizes are summed from that;
    3. the distinct rows, which are unique so a content salt spreads a hot
       key, are semi-joined to the large keys;
    4. the copies are expanded back in bounded chunks spread over tasks.
    When the key is the whole row, no join is needed at all."""
    rows = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("_copies"))
    if set(keys) == set(df.columns):
        kept = rows.filter(F.col("_copies") > n)
    else:
        rows = stored(rows, "row-copies")
        big = (rows.groupBy(*keys).agg(F.sum("_copies").alias("_key_rows"))
               .filter(F.col("_key_rows") > n).select(*keys))
        kept = skew_safe_join(rows, big, keys, "left_semi", null_safe=True)
    return expand_counts(kept, "_copies").select(*df.columns)


def duplicate_members(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Every member of a duplicate group (pandas ``duplicated(keep=False)``)."""
    return groups_larger_than(df, list(columns or df.columns), 1)


def duplicate_summary(df: DataFrame) -> DataFrame:
    """One row: rows, distinct rows, rows a full-row distinct removes."""
    groups = key_counts(df, df.columns, "_n")
    return groups.agg(F.sum("_n").cast("long").alias("n_rows"),
                      F.count(F.lit(1)).alias("n_distinct"),
                      F.sum(F.col("_n") - 1).cast("long").alias("n_duplicates"))


def by_range(df: DataFrame, order: Sequence[str | Column], num_partitions: int | None = None) -> DataFrame:
    """Range-partition on ``order``. Without an explicit count AQE may merge
    small neighbouring ranges, which keeps the global order and keeps each
    key's rows together."""
    cols = _cols(order)
    return df.repartitionByRange(num_partitions, *cols) if num_partitions else df.repartitionByRange(*cols)


def number_sorted_partitions(df: DataFrame, id_col: str = "row_id", start: int = 0) -> DataFrame:
    """Dense ids in the frame's current order, for a frame whose partitions are
    already in global order (range-partitioned and sorted within partitions).

    Rows are numbered inside each partition and stored as Parquet in the shared
    folder. That fixes the range boundaries and cuts lineage, so a lost executor
    recomputes nothing differently, and later scans are pruned. Each partition's
    offset then
    comes from a table with one row per partition, broadcast because its size is
    bounded by the partition count. No row passes through a single task.
    """
    cols = [F.col(f"`{c}`") for c in df.columns]
    staged = stored(df.withColumn("_pid", F.spark_partition_id())
                    .withColumn("_mid", F.monotonically_increasing_id()), "numbered")
    per_part = staged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select("_pid", "_first",
                              F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    idx = F.col("_mid") - F.col("_first") + F.col("_off") + F.lit(start)
    return staged.join(F.broadcast(offsets), "_pid").select(*cols, idx.cast("long").alias(id_col))


def assign_surrogate_id(df: DataFrame, order_by: Sequence[str | Column], id_col: str = "row_id",
                        start: int = 0, num_partitions: int | None = None) -> DataFrame:
    """Dense ids ``start, start+1, ...`` following ``order_by``; stable once built.

    Range-partition on the order (sampled boundaries also split a hot value when
    the order is total), sort inside partitions, then
    :func:`number_sorted_partitions`.
    """
    order = _cols(order_by)
    return number_sorted_partitions(by_range(df, order, num_partitions).sortWithinPartitions(*order),
                                    id_col, start)


def patch_by_key(df: DataFrame, patch: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Overwrite ``columns`` of the rows whose ``key`` appears in ``patch`` with
    the patch values (also when the patch value is NULL); other rows unchanged.
    The patch is reduced to one row per key (smallest values) so no row is
    duplicated. Never appends rows."""
    p = keep_first(patch.select(key, *columns), [key], list(columns))
    p = p.select(F.col(key).alias("_pk"), F.lit(True).alias("_hit"),
                 *[F.col(c).alias(f"_p_{c}") for c in columns])
    joined = df.join(p, df[key] == p["_pk"], "left")
    out = []
    for c in df.columns:
        if c in columns:
            out.append(F.when(F.col("_hit"), F.col(f"_p_{c}")).otherwise(df[c]).alias(c))
        else:
            out.append(df[c])
    return joined.select(*out)
