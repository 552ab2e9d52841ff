"""Constraint checks for tables whose storage does not enforce them.

Parquet tables accept duplicate keys and NULLs silently, so primary keys, NOT
NULL and foreign keys are checked as queries. Each check returns the violations
as a DataFrame (empty = pass); ``assert_*`` helpers fail loudly and show at most
a handful of offending keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class QualityError(AssertionError):
    pass


def primary_key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that repeat or contain NULL, with their row count."""
    any_null = None
    for k in keys:
        e = F.col(k).isNull()
        any_null = e if any_null is None else any_null | e
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter((F.col("n_rows") > 1) | any_null))


def foreign_key_violations(child: DataFrame, fk: Sequence[str], parent: DataFrame,
                           pk: Sequence[str]) -> DataFrame:
    """Non-NULL child key values with no parent row, with the child row count.

    The child is reduced to its distinct key values (partial aggregation) before
    the anti join, so the shuffle moves keys, not rows."""
    not_null = None
    for c in fk:
        e = F.col(c).isNotNull()
        not_null = e if not_null is None else not_null & e
    keys = child.filter(not_null).groupBy(*fk).agg(F.count(F.lit(1)).alias("n_rows"))
    p = parent.select(*[F.col(c).alias(f"_pk_{i}") for i, c in enumerate(pk)])
    cond = None
    for i, c in enumerate(fk):
        e = keys[c] == p[f"_pk_{i}"]
        cond = e if cond is None else cond & e
    return keys.join(p, cond, "left_anti")


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, null_count) for each column, from one aggregate pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "null_count")


def not_null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return null_counts(df, columns).filter(F.col("null_count") > 0)


def row_count_check(expected: DataFrame, loaded: DataFrame, name: str) -> DataFrame:
    """One row: table name, rows expected, rows loaded, equal?"""
    loaded_n = loaded.select(F.count(F.lit(1))).scalar()
    return (expected.agg(F.count(F.lit(1)).alias("expected_rows"))
            .select(F.lit(name).alias("table_name"), "expected_rows",
                    loaded_n.alias("loaded_rows"))
            .withColumn("ok", F.col("expected_rows") == F.col("loaded_rows")))


def rows_per_file_check(df_with_file: DataFrame, file_col: str = "source_file") -> DataFrame:
    """One row: rows, distinct source files, equal? (one object per file)."""
    per_file = df_with_file.groupBy(file_col).agg(F.count(F.lit(1)).alias("_n"))
    return (per_file.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("n_rows"),
                         F.count(F.lit(1)).alias("n_files"))
            .withColumn("ok", F.col("n_rows") == F.col("n_files")))


def _fail_if_any(violations: DataFrame, what: str) -> None:
    sample = violations.take(5)
    if sample:
        raise QualityError(f"{what}: e.g. {[r.asDict() for r in sample]}")


def assert_primary_key(df: DataFrame, keys: Sequence[str], table: str = "table") -> None:
    _fail_if_any(primary_key_violations(df, keys), f"{table}: primary key {list(keys)} violated")


def assert_foreign_key(child: DataFrame, fk: Sequence[str], parent: DataFrame, pk: Sequence[str],
                       table: str = "table") -> None:
    _fail_if_any(foreign_key_violations(child, fk, parent, pk),
                 f"{table}: foreign key {list(fk)} -> {list(pk)} violated")


def assert_not_null(df: DataFrame, columns: Sequence[str], table: str = "table") -> None:
    _fail_if_any(not_null_violations(df, columns), f"{table}: NOT NULL violated")


def assert_row_counts_equal(a: DataFrame, b: DataFrame, name_a: str = "a", name_b: str = "b") -> None:
    """Fail unless both tables hold the same number of rows (e.g. the 1:1 pair
    songplays / times)."""
    r = row_count_check(a, b, name_a).collect()[0]
    if not r.ok:
        raise QualityError(f"{name_a} has {r.expected_rows} rows but {name_b} has {r.loaded_rows}")


def check_star(tables: dict[str, DataFrame]) -> None:
    """Every declared constraint of the five star tables (playstats.schemas). On
    tables stored in buckets of their key the group-bys and the fact-times check
    need no exchange."""
    from playstats.schemas import FOREIGN_KEYS, NOT_NULL, PRIMARY_KEYS

    for name, df in tables.items():
        if name in PRIMARY_KEYS:
            assert_primary_key(df, PRIMARY_KEYS[name], name)
        if name in NOT_NULL:
            assert_not_null(df, NOT_NULL[name], name)
        for fk, parent, pk in FOREIGN_KEYS.get(name, []):
            if parent in tables:
                assert_foreign_key(df, [fk], tables[parent], [pk], name)
