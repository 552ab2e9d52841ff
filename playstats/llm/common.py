"""Helpers shared by the operators: input projection, storage, Arrow text.

Conventions of every operator here:

* only the id and text columns named by the caller are read; all other input
  columns are projected away first, so extra columns cannot clash;
* a null text counts as the empty text;
* intermediate tables live below ``spark.checkpoint.dir`` (shared by driver and
  executors); nothing is kept in executor-local files.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Texts are handled in groups of about so many characters inside a task, so the
#: arrays derived from them stay small whatever the size of the Arrow batch.
CHUNK_CHARS = 1 << 20


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: Column) -> DataFrame:
    """(doc_id, text) with null texts as '', and ``more``; nothing else of the input."""
    return df.select(F.col(f"`{id_col}`").alias("doc_id"),
                     F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"), *more)


def handed_on(column: str | None) -> list[Column]:
    """The column as ``row``; none without a name."""
    return [] if column is None else [F.col(f"`{column}`").alias("row")]


def with_row(schema: str, docs: DataFrame) -> StructType:
    """The schema, and the ``row`` of ``docs`` where it has one."""
    return StructType([*StructType.fromDDL(schema), *[f for f in docs.schema if f.name == "row"]])


def find_package(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver did, for
    sessions started elsewhere. (On a cluster the package is shipped with
    ``--py-files``; a path that a machine lacks is ignored there.)"""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    known = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([root, *known])


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder (spark.checkpoint.dir). Where a local test
    session names none, a folder below the warehouse directory."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    return root.rstrip("/")


def shared_path(spark: SparkSession, label: str) -> str:
    """A new, unique folder name below :func:`shared_root`."""
    return f"{shared_root(spark)}/llm/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read again: cuts
    the lineage, survives lost executors, and can be scanned many times."""
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_chunks(batches: Iterator[pa.RecordBatch], text: str = "text",
                limit: int = CHUNK_CHARS) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the batches with about ``limit`` characters of text each (one
    text at least), and the slice's texts as a list of str."""
    for batch in batches:
        sizes = np.cumsum(np.asarray(
            pc.binary_length(batch.column(text)).fill_null(0), dtype=np.int64))
        at = 0
        while at < batch.num_rows:
            done = int(sizes[at - 1]) if at else 0
            end = max(at + 1, int(np.searchsorted(sizes, done + limit, side="right")))
            part = batch.slice(at, end - at)
            yield part, [t or "" for t in part.column(text).to_pylist()]
            at = end
