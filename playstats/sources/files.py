"""JSON Lines directory scans (song metadata, activity logs).

A source root is walked recursively; only files matching the glob are read, so a
stray ``.txt`` next to the JSON is ignored, and folders starting with ``.`` or
``_`` (editor checkpoints, commit markers) are skipped by Spark's file index.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _check_root(root: str) -> None:
    if root is None or root == "":
        raise ValueError("empty source folder")


def _reader(spark: SparkSession, glob: str):
    return (spark.read.option("recursiveFileLookup", "true")
            .option("pathGlobFilter", glob))


def list_files(spark: SparkSession, root: str, glob: str = "*.json") -> DataFrame:
    """All files below ``root`` matching ``glob``, one row per absolute path.

    The listing runs on the file index; the ``binaryFile`` source never opens a
    file unless its ``content`` column is selected.
    """
    _check_root(root)
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", glob).load(root)
            .select(F.col("path").alias("file_path"), F.col("length").alias("file_bytes")))


def merge_schema(declared: T.StructType, inferred: T.StructType) -> T.StructType:
    """Declared fields keep their declared type; other inferred fields are kept."""
    declared_names = {f.name for f in declared.fields}
    extra = [f for f in inferred.fields
             if f.name not in declared_names and f.name != "_corrupt_record"]
    return T.StructType(list(declared.fields) + extra)


def read_json_lines(spark: SparkSession, root: str, schema: T.StructType,
                    glob: str = "*.json", distinct: bool = True, undeclared: str = "keep",
                    sampling_ratio: float = 1.0, source_file_col: str | None = None,
                    keep_extra: bool = False, on_bad: str = "fail") -> DataFrame:
    """Scan every JSON Lines file below ``root`` as one table of the declared
    fields; with ``distinct`` only distinct rows.

    A line that is no JSON object, or a field whose text does not convert to its
    declared type, fails the job (``on_bad='fail'``). With
    ``on_bad='quarantine'`` (keep mode) such a line becomes a row of NULLs with
    the line in column ``_bad``; :func:`split_bad` separates them.

    ``undeclared`` decides how fields the schema does not name take part:

    * ``'keep'`` (default, one pass): every line is parsed once, into a map of
      texts; declared fields are converted from it. The undeclared non-null
      entries, sorted, join the distinct key and are then dropped. Two events
      that differ only in such a field stay two rows.
    * ``'infer'``: one inference pass over all files, then undeclared fields
      are kept as columns with inferred types. This reads the data twice.
    * ``'drop'``: declared fields only.

    Type-only duplicates (``88`` vs ``"88"`` for a text field) collapse in every
    mode, because the parser yields the same text for both.

    ``keep_extra=True`` (keep mode) returns the undeclared entries as column
    ``_extra``, so a caller can run the distinct itself on a partitioning it
    also needs for something else (see ``plans.star.prepare_plays``).
    """
    _check_root(root)
    if on_bad not in ("fail", "quarantine"):
        raise ValueError("on_bad must be 'fail' or 'quarantine'")
    if undeclared == "keep":
        text = _reader(spark, glob).text(root)
        if source_file_col:
            text = text.withColumn(source_file_col, F.col("_metadata.file_path"))
        text = text.filter(F.trim(F.col("value")) != "")          # blank lines are no records
        names = [f.name for f in schema.fields]
        mode = "FAILFAST" if on_bad == "fail" else "PERMISSIVE"
        entries = F.from_json(F.col("value"), T.MapType(T.StringType(), T.StringType()), {"mode": mode})
        extra_cols = [source_file_col] if source_file_col else []
        parsed = text.select("value", entries.alias("_map"), *extra_cols)
        raw = {f.name: F.try_element_at("_map", F.lit(f.name)) for f in schema.fields}
        converted = {f.name: raw[f.name].try_cast(f.dataType) for f in schema.fields}
        wrong = [raw[n].isNotNull() & converted[n].isNull() for n in names]
        if on_bad == "fail":
            for n, bad in zip(names, wrong):
                converted[n] = F.when(bad, F.raise_error(F.concat(
                    F.lit(f"field {n} does not convert: "), F.col("value")))).otherwise(converted[n])
            bad_cols = []
        else:
            is_bad = F.col("_map").isNull()
            for bad in wrong:
                is_bad = is_bad | bad
            parsed = parsed.withColumn("_bad", F.when(is_bad, F.col("value")))
            parsed = parsed.withColumn("_map", F.when(F.col("_bad").isNull(), F.col("_map")))
            bad_cols = ["_bad"]
        extra = F.array_sort(F.map_entries(F.map_filter(
            "_map", lambda k, v: ~k.isin(*names) & v.isNotNull())))
        df = parsed.select(*[converted[f.name].cast(f.dataType).alias(f.name) for f in schema.fields],
                           extra.alias("_extra"), *bad_cols, *extra_cols)
        if distinct:
            df = df.dropDuplicates()
        return df if keep_extra else df.drop("_extra")

    full = schema
    if undeclared == "infer":
        try:
            inferred = (_reader(spark, glob).option("samplingRatio", sampling_ratio)
                        .json(root).schema)
            full = merge_schema(schema, inferred)
        except Exception as exc:  # empty folder: nothing to infer from
            if "UNABLE_TO_INFER_SCHEMA" not in str(exc) and "infer" not in str(exc).lower():
                raise
    elif undeclared != "drop":
        raise ValueError("undeclared must be 'keep', 'infer' or 'drop'")
    if on_bad != "fail":
        raise ValueError("bad lines can be set aside in 'keep' mode only")
    df = _reader(spark, glob).schema(full).option("mode", "FAILFAST").json(root)
    if source_file_col:
        df = df.withColumn(source_file_col, F.col("_metadata.file_path"))
    return df.dropDuplicates() if distinct else df


def split_bad(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad lines) of a frame read with ``on_bad='quarantine'``."""
    return df.filter(F.col("_bad").isNull()).drop("_bad"), df.filter(F.col("_bad").isNotNull()).select(
        F.col("_bad").alias("line"))


def with_source_file(df: DataFrame, name: str = "source_file") -> DataFrame:
    """Add the provenance column (the file each row was read from) to a frame
    straight from a file reader; ``read_json_lines(source_file_col=...)`` does
    the same inside the scan."""
    return df.withColumn(name, F.col("_metadata.file_path"))


def parent_folder(path_col: Column | str) -> Column:
    """Name of the folder that holds a file (last path element but one)."""
    c = F.col(path_col) if isinstance(path_col, str) else path_col
    return F.regexp_extract(c, r"([^/]+)/[^/]+$", 1)
