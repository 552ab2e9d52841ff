"""Frame cleaning and text-to-number conversion.

All rules are column expressions combined into one ``select``; they run inside
whole-stage codegen with no Python in the row path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FLOATS = (T.FloatType, T.DoubleType)


def clean_text(c: Column, empty_to_null: bool = True, null_token: str | None = None,
               sep: str | None = "\t", sep_replace: str = "", whole_cell: bool = False) -> Column:
    """Cleaning rules for one text column, in the order the ETL applies them:
    empty text -> NULL, optional null token -> NULL, then separator removal."""
    out = c
    if empty_to_null:
        out = F.nullif(out, F.lit(""))
    if null_token is not None:
        out = F.nullif(out, F.lit(null_token))
    if sep:
        if whole_cell:  # strict parity: only cells that are exactly the separator
            out = F.when(out == F.lit(sep), F.lit(sep_replace)).otherwise(out)
        else:           # documented intent: the separator disappears from every cell
            out = F.replace(out, F.lit(sep), F.lit(sep_replace))
    return out


def clean_frame(df: DataFrame, empty_to_null: bool = True, nan_to_null: bool = True,
                null_token: str | None = None, sep: str | None = "\t", sep_replace: str = "",
                whole_cell: bool = False, columns: list[str] | None = None) -> DataFrame:
    """Prepare a frame for loading: NaN -> NULL in float columns, empty text ->
    NULL (switchable), separator removed from text. Real NULLs stay NULL; a null
    marker is only produced by the delimited sink."""
    targets = set(columns) if columns is not None else None
    exprs = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if targets is not None and field.name not in targets:
            exprs.append(c)
        elif isinstance(field.dataType, T.StringType):
            exprs.append(clean_text(c, empty_to_null, null_token, sep, sep_replace,
                                    whole_cell).alias(field.name))
        elif nan_to_null and isinstance(field.dataType, _FLOATS):
            exprs.append(F.when(F.isnan(c), F.lit(None).cast(field.dataType))
                         .otherwise(c).alias(field.name))
        else:
            exprs.append(c)
    return df.select(*exprs)


def convert(c: Column, target: str) -> tuple[Column, Column]:
    """(the text as a number or NULL, is it text that is no number)."""
    number = c.try_cast(target)
    return number, c.isNotNull() & number.isNull()


def to_number(df: DataFrame, column: str, target: str = "int", strict: bool = True,
              alias: str | None = None) -> DataFrame:
    """Convert a text column to a number.

    Strict mode fails the job on text that is not a number, under any ANSI
    setting; NULL stays NULL. Use :func:`split_numeric` for a lenient run.
    """
    src = F.col(column)
    conv, bad = convert(src, target)
    if strict:
        conv = F.when(bad,
                      F.raise_error(F.concat(F.lit(f"not a number in {column}: '"), src, F.lit("'")))
                      ).otherwise(conv).cast(target)
    return df.withColumn(alias or column, conv)


def flag_numeric(df: DataFrame, column: str, target: str = "int", alias: str | None = None,
                 flag: str = "rejected") -> DataFrame:
    """Lenient conversion of every row: the number (NULL if there is none) and
    whether the text was rejected."""
    number, bad = convert(F.col(column), target)
    return df.withColumns({flag: bad, alias or column: number})


def split_numeric(df: DataFrame, column: str, target: str = "int",
                  alias: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Lenient conversion: (rows that convert, with the column converted;
    rejected rows, untouched)."""
    number, bad = convert(F.col(column), target)
    return df.filter(~bad).withColumn(alias or column, number), df.filter(bad)
