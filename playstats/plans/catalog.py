"""Catalog administration: databases and tables, reset, statement lists.

Statements run one after another through ``spark.sql``; the first failure
stops the list and propagates (nothing is swallowed).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playstats.schemas import TABLES, ddl


def fresh_table_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


def run_statements(spark: SparkSession, statements: Sequence[str]) -> bool:
    """Run SQL statements in order; raise on the first failure."""
    if not isinstance(statements, (list, tuple)):
        raise TypeError("statements must be a list of SQL strings")
    for stmt in statements:
        spark.sql(stmt)
    return True


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{loc}")


def drop_statements(db: str) -> list[str]:
    return [f"DROP TABLE IF EXISTS {db}.{t}" for t in TABLES]


def create_statements(db: str, root: str) -> list[str]:
    return [f"CREATE TABLE IF NOT EXISTS {db}.{t} ({ddl(s)}) USING parquet LOCATION '{root}/{t}'"
            for t, s in TABLES.items()]


def reset_warehouse(spark: SparkSession, db: str, root: str) -> bool:
    """Drop and recreate the database, then drop and create the five star
    tables at ``root/<table>``; stops at the first failing step."""
    return (run_statements(spark, [f"DROP DATABASE IF EXISTS {db} CASCADE"])
            and run_statements(spark, [f"CREATE DATABASE {db} LOCATION '{root}/_db'"])
            and run_statements(spark, drop_statements(db))
            and run_statements(spark, create_statements(db, root)))


def list_databases(spark: SparkSession) -> DataFrame:
    names = [d.name for d in spark.catalog.listDatabases()]
    return spark.createDataFrame([(n,) for n in names], "database string")


def list_tables(spark: SparkSession, db: str, pattern: str | None = None) -> DataFrame:
    """Tables of one database, sorted by name (``SHOW TABLES`` as a DataFrame)."""
    q = f"SHOW TABLES IN {db}" + (f" LIKE '{pattern}'" if pattern else "")
    return (spark.sql(q).filter(~F.col("isTemporary"))
            .select(F.col("namespace").alias("table_schema"), F.col("tableName").alias("table_name"))
            .orderBy("table_schema", "table_name"))
