"""Small files beside the tables: an append-only log of numbered commits.

Files are reached through Hadoop's file system API on the driver, so the log lies
in the same store as the tables (HDFS, an object store, a local folder). A commit
is written under another name and then renamed without overwriting: readers see
the whole of it or nothing, and of two writers of the same number one fails.
"""

from __future__ import annotations

import json
import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class ConcurrentCommit(RuntimeError):
    """Another writer has taken the number."""


class Folder:
    """A folder in any store that Spark reads."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._at().getFileSystem(self._conf)

    def _at(self, name: str = ""):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._at(name))

    def is_folder(self, name: str) -> bool:
        return self._fs.getFileStatus(self._at(name)).isDirectory()

    def names(self, name: str = "") -> list[str]:
        """Names in the folder, sorted; none where there is no such folder."""
        if not self._fs.exists(self._at(name)):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._at(name)))

    def age_seconds(self, name: str) -> float:
        now = self._jvm.java.lang.System.currentTimeMillis()
        return (now - self._fs.getFileStatus(self._at(name)).getModificationTime()) / 1000

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> None:
        """A new file with its whole content; :class:`ConcurrentCommit` if there is one."""
        self._fs.mkdirs(self._at())
        draft = f".draft-{uuid.uuid4().hex}"
        stream = self._fs.create(self._at(draft), False)
        stream.write(bytearray(text.encode("utf-8")))
        stream.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._at().toUri(), self._conf)
        no_options = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(context.makeQualified(self._at(draft)), context.makeQualified(self._at(name)), no_options)
        except Py4JJavaError as exc:
            self._fs.delete(self._at(draft), False)
            if "FileAlreadyExists" in str(exc.java_exception.toString()):
                raise ConcurrentCommit(f"{self.path}/{name} exists") from exc
            raise

    def remove(self, name: str) -> None:
        self._fs.delete(self._at(name), True)


class CommitLog:
    """Numbered JSON commits, 1, 2, 3, ...; the last one holds."""

    def __init__(self, spark: SparkSession, path: str):
        self.folder = Folder(spark, path)

    def numbers(self) -> list[int]:
        return [int(n[:-5]) for n in self.folder.names() if re.fullmatch(r"\d{12}\.json", n)]

    def get(self, number: int) -> dict:
        return json.loads(self.folder.read(f"{number:012}.json"))

    def last(self) -> tuple[int, dict]:
        """(number, commit); (0, {}) of an empty log."""
        numbers = self.numbers()
        return (numbers[-1], self.get(numbers[-1])) if numbers else (0, {})

    def add(self, number: int, commit: dict) -> None:
        self.folder.create(f"{number:012}.json", json.dumps(commit))

    def forget(self, number: int) -> None:
        self.folder.remove(f"{number:012}.json")
