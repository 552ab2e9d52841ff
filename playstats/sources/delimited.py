"""Headerless delimited text (the bulk-load exchange format) and plain CSV.

Line breaks and backslashes inside a cell are escaped by the sink (``\\n``,
``\\r``, ``\\\\``) and restored here by expressions, so a record never spans lines
and large files stay splittable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL_TOKEN = "NULL"
#: NULL in the CSV variant; a cell holding these two characters is written with its backslash escaped.
CSV_NULL = "\\N"


def escape(c: Column) -> Column:
    out = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(out, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def unescape(c: Column) -> Column:
    # every backslash of the escaped text starts a pair: cut at escaped backslashes first
    parts = F.split(c, r"\\\\", -1)
    plain = F.transform(parts, lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")))
    return F.array_join(plain, "\\")


def _read(spark: SparkSession, path: str, schema: T.StructType, sep: str, header: bool,
          null: str | None) -> DataFrame:
    reader = (spark.read.schema(schema).option("sep", sep).option("header", str(header).lower())
              .option("quote", '"').option("escape", '"').option("mode", "FAILFAST"))
    if null is not None:
        reader = reader.option("nullValue", null)
    raw = reader.csv(path)
    return raw.select(*[unescape(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType)
                        else F.col(f"`{f.name}`") for f in schema.fields])


def read_tsv(spark: SparkSession, path: str, schema: T.StructType,
             sep: str = "\t", null_token: str | None = NULL_TOKEN) -> DataFrame:
    """Read what :func:`playstats.sinks.write_tsv` wrote: explicit columns, quote
    and escape ``"``, the null token becomes NULL."""
    return _read(spark, path, schema, sep, False, null_token)


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             header: bool = False) -> DataFrame:
    """Comma-separated variant: NULL, the empty string and every other text are
    told apart."""
    return _read(spark, path, schema, ",", header, CSV_NULL)
