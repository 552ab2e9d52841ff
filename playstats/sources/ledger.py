"""A ledger of the source files that earlier runs have loaded.

``FileLedger.pending`` lists a source tree, folder by folder, and returns the files
that are new or have changed (another size or time) since they were last loaded;
``commit`` notes them once their rows are safely stored. A run over an unchanged
tree opens no source file.

The ledger is a Parquet table (path, size, time, run) in the store of the tables. A
listing is written to it as it is found, one top folder after another, and compared
with the noted files by a join, so neither is held by the driver. Each run is a
folder of its own that a commit (``playstats.storage``) makes valid: a run that dies
before its commit has loaded nothing, as far as the ledger knows, and its files are
pending again.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playstats.storage import CommitLog, Folder

FILES = "file_path string, file_bytes bigint, modified timestamp"


def list_tree(spark: SparkSession, root: str, glob: str = "*.json") -> Iterator[DataFrame]:
    """The files below ``root``, by top folder: one listing for the files in ``root`` itself
    and one for each folder in it. A listing of many folders is spread over the cluster
    by Spark's file index."""
    root = root.rstrip("/")
    folder = Folder(spark, root)
    if not folder.exists():
        raise FileNotFoundError(root)
    entries = [n for n in folder.names() if not n.startswith((".", "_"))]
    folders = [n for n in entries if folder.is_folder(n)]
    if len(folders) < len(entries):
        yield _listed(spark.read.format("binaryFile").option("pathGlobFilter", glob), root)
    for name in folders:
        yield _listed(spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                      .option("pathGlobFilter", glob), f"{root}/{name}")


def _listed(reader, path: str) -> DataFrame:
    # the content is not selected, so no file is opened
    return reader.load(path).select(F.col("path").alias("file_path"), F.col("length").alias("file_bytes"),
                                    F.col("modificationTime").alias("modified"))


class FileLedger:
    """The loaded files of one source, noted below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.log = CommitLog(spark, f"{self.root}/_commits")

    def _runs(self) -> list[str]:
        return self.log.last()[1].get("runs", [])

    def loaded(self) -> DataFrame:
        """(file_path, file_bytes, modified) of every loaded file as it was when it was last
        loaded."""
        runs = self._runs()
        if not runs:
            return self.spark.createDataFrame([], FILES)
        rows = self.spark.read.schema(f"{FILES}, run int").parquet(*[f"{self.root}/{r}" for r in runs])
        return rows.groupBy("file_path").agg(F.max_by(F.struct("file_bytes", "modified"), "run").alias("f")).select(
            "file_path", "f.file_bytes", "f.modified")

    def pending(self, source: str, glob: str = "*.json") -> PendingFiles:
        """The files of ``source`` that are new or have changed since they were loaded."""
        run = f"run-{uuid.uuid4().hex}"
        listing = f"{self.root}/_listing-{run}"
        for files in list_tree(self.spark, source, glob):
            files.write.mode("append").parquet(listing)
        listed = self.spark.read.schema(FILES).parquet(listing) if Folder(self.spark, listing).exists() \
            else self.spark.createDataFrame([], FILES)
        known = self.loaded().withColumn("_known", F.lit(True))
        new = listed.join(known, ["file_path", "file_bytes", "modified"], "left_anti")
        (new.withColumn("run", F.lit(self.log.last()[0] + 1)).write.parquet(f"{self.root}/{run}"))
        Folder(self.spark, self.root).remove(f"_listing-{run}")
        return PendingFiles(self, run)


class PendingFiles:
    """The files of one run that are to be loaded."""

    def __init__(self, ledger: FileLedger, run: str):
        self.ledger, self.run, self.base = ledger, run, ledger.log.last()[0]

    def files(self) -> DataFrame:
        return self.ledger.spark.read.schema(FILES).parquet(f"{self.ledger.root}/{self.run}")

    def is_empty(self) -> bool:
        return self.files().isEmpty()

    def paths(self, most: int = 50_000) -> Iterator[list[str]]:
        """The paths in groups of ``most``, so that a run over any number of files holds
        one group at a time."""
        group: list[str] = []
        for r in self.files().select("file_path").orderBy("file_path").toLocalIterator():
            group.append(re.sub(r"([\[\]{}*?\\])", r"\\\1", r.file_path))  # a reader takes paths for patterns
            if len(group) == most:
                yield group
                group = []
        if group:
            yield group

    def read(self, reader: Callable[[list[str]], DataFrame], most: int = 50_000) -> DataFrame | None:
        """``reader`` applied to groups of paths, as one frame; None without pending files."""
        out = None
        for paths in self.paths(most):
            rows = reader(paths)
            out = rows if out is None else out.unionByName(rows)
        return out

    def commit(self) -> None:
        """Notes the files as loaded. Of two runs that listed the same state one succeeds
        (:class:`playstats.storage.ConcurrentCommit`). A run without files notes nothing."""
        if self.is_empty():
            Folder(self.ledger.spark, self.ledger.root).remove(self.run)
            return
        self.ledger.log.add(self.base + 1, {"runs": [*self.ledger._runs(), self.run]})
