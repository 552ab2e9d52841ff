"""Describe-style profiles computed as distributed aggregates.

Counts and moments of all columns come from one global aggregate (one row,
reshaped to one row per column), so every requested column appears even with
no values. Value frequencies, number profiles and ranks work on (column_name,
value, count), from one pass over the data. Exact quartiles use cumulative
counts over range-partitioned distinct values instead of an exact ``percentile``
aggregate, whose final merge would hold every distinct value of a column in one
task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from playstats.operators.keys import by_range
from playstats.scratch import stored


def _long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).unpivot([], list(columns), "column_name", "value")


def _per_column(df: DataFrame, columns: Sequence[str], stats) -> DataFrame:
    """One global aggregate (always exactly one row, partial per task) with a
    struct of ``stats(column)`` per column, reshaped to one row per column."""
    row = df.agg(*[stats(F.col(c)).alias(c) for c in columns])
    return row.unpivot([], list(columns), "column_name", "_s").select("column_name", "_s.*")


def _value_frequencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count / unique / top / freq / first / last per column (top: most
    frequent, then smallest). Every column gets a row, also with no values."""
    base = _per_column(df, columns, lambda c: F.struct(F.count(c).alias("count")))
    freq = (_long(df, columns).filter(F.col("value").isNotNull())
            .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("_n")))
    rank = F.struct((-F.col("_n")).alias("neg_n"), F.col("value").alias("v"))
    summary = freq.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("unique"), F.min_by(F.col("value"), rank).alias("top"),
        F.max("_n").alias("freq"), F.min("value").alias("first"), F.max("value").alias("last"))
    return (base.join(summary, "column_name", "left")
            .withColumn("unique", F.coalesce(F.col("unique"), F.lit(0).cast("long"))))


def profile_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """pandas ``describe(include=['O'])``: count, unique, top, freq per column."""
    return _value_frequencies(df.select(*[F.col(c).cast("string").alias(c) for c in columns]),
                              columns).select("column_name", "count", "unique", "top", "freq")


def profile_timestamp(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Timestamp describe: count, unique, top, freq, first, last."""
    return _value_frequencies(df, columns).select("column_name", "count", "unique", "top",
                                                  "freq", "first", "last")


def value_counts(long: DataFrame, group: str = "column_name", value: str = "value") -> DataFrame:
    """(group, value, _n) of the non-NULL values, stored: the one pass over the
    data. A value that fills a third of a column is one row per task here."""
    return stored(long.filter(F.col(value).isNotNull()).groupBy(group, value)
                  .agg(F.count(F.lit(1)).alias("_n")), "value-counts")


def exact_quantiles(counts: DataFrame, probs: Sequence[float] = (0.25, 0.5, 0.75),
                    group: str = "column_name", value: str = "value") -> DataFrame:
    """Linear-interpolated quantiles (pandas / ``quantile_cont``) per group from
    its distinct values and their counts ``_n``: one row per (group, p) with
    column ``q``.

    The distinct values are range-partitioned and get their cumulative counts
    per partition; offsets come from a table of one row per partition and
    group. No value or group has to fit one task."""
    ranged = stored(by_range(counts, [group, value]).withColumn("_pid", F.spark_partition_id()), "value-ranges")
    per = ranged.groupBy("_pid", group).agg(F.sum("_n").alias("_rows"))
    before = Window.partitionBy(group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("_pid", group, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy("_pid", group).orderBy(value)
    # a value takes the ranks (_to - _n) .. (_to - 1)
    ranked = (ranged.withColumn("_sum", F.sum("_n").over(inside)).join(per, ["_pid", group])
              .select(group, value, "_n", (F.col("_sum") + F.col("_off")).alias("_to")))
    wanted = (counts.groupBy(group).agg(F.sum("_n").alias("_total"))
              .withColumn("p", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
              .withColumn("_pos", F.col("p") * (F.col("_total") - 1))
              .select(group, "p", F.floor("_pos").cast("long").alias("_lo"), F.ceil("_pos").cast("long").alias("_hi"),
                      (F.col("_pos") - F.floor("_pos")).alias("_frac")))
    holds = [(F.col(x) >= F.col("_to") - F.col("_n")) & (F.col(x) < F.col("_to")) for x in ("_lo", "_hi")]
    picked = (ranked.join(F.broadcast(wanted), group).filter(holds[0] | holds[1])   # groups x probs rows
              .groupBy(group, "p", "_frac")
              .agg(F.max(F.when(holds[0], F.col(value))).alias("_vlo"), F.max(F.when(holds[1], F.col(value))).alias("_vhi")))
    return picked.select(group, "p", (F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * F.col("_frac")).alias("q"))


def profile_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """pandas ``describe()`` for numbers: count, mean, std (n-1), min, 25%, 50%,
    75% (linear interpolation), max. NaN counts as missing, like NULL.

    The data is read once: the moments are observed by the job that counts the
    values."""
    columns = list(columns)
    values = df.select(*[F.nullif(F.col(c).cast("double"), F.lit(float("nan"))).alias(c) for c in columns])
    stats = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    seen = Observation()
    observed = values.observe(seen, *[f(F.col(c)).alias(f"{name}_{i}") for i, c in enumerate(columns)
                                      for name, f in stats.items()])
    counts = value_counts(observed.unpivot([], columns, "column_name", "value"))
    q = exact_quantiles(counts)
    quart = q.groupBy("column_name").agg(
        *[F.max(F.when(F.col("p") == p, F.col("q"))).alias(name)
          for p, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))])
    # without any value the planner may leave out the observed step
    got = {} if counts.isEmpty() else seen.get
    moments = df.sparkSession.createDataFrame(
        [(c, got.get(f"count_{i}", 0), *[got.get(f"{name}_{i}") for name in list(stats)[1:]])
         for i, c in enumerate(columns)],
        "column_name string, count long, mean double, std double, min double, max double")
    return (moments.join(quart, "column_name", "left")
            .select("column_name", "count", "mean", "std", "min", "p25", "p50", "p75", "max"))


def profile_dtypes(df: DataFrame) -> DataFrame:
    """Column types (``df.dtypes``) with each column's non-null count."""
    names = df.columns
    types = F.create_map(*[x for n, t in df.dtypes for x in (F.lit(n), F.lit(t))])
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in names])
    return (counts.unpivot([], names, "column_name", "non_null")
            .select("column_name", F.element_at(types, F.col("column_name")).alias("data_type"),
                    "non_null"))


def key_cardinality(df: DataFrame, column: str) -> DataFrame:
    """Rows, non-null values, distinct non-null values, and distinct values
    counting NULL as one value (pandas ``unique()``)."""
    c = F.col(column)
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count(c).alias("n_non_null"),
                  F.count_distinct(c).alias("n_distinct"),
                  (F.count_distinct(c) + F.max(F.when(c.isNull(), 1).otherwise(0))).alias("n_unique"))
