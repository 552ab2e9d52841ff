"""Row numbers that go on from load to load.

A :class:`Sequence` keeps, in a shared folder, which blocks of numbers it has given
to which batch (``playstats.storage``). A batch reserves one block for all its rows
before it numbers them, so

* the next batch goes on behind it, in whatever session it runs;
* a batch that is tried again under its name gets the same block, and the same
  number for every row;
* two loads at the same time get different blocks: the second one to commit sees
  that the number is taken and reserves again behind it.

A batch that reserves and then never stores its rows leaves a gap, as a database
sequence does.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence as Columns

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playstats.operators.keys import by_range, number_sorted_partitions
from playstats.storage import CommitLog, ConcurrentCommit


class Sequence:
    """Numbers ``first``, ``first + 1``, ... kept under ``root/name``."""

    def __init__(self, spark: SparkSession, root: str, name: str, first: int = 0):
        self.first = first
        folder = f"{root.rstrip('/')}/{name}"
        self.blocks = CommitLog(spark, f"{folder}/blocks")   # the high-water mark
        self.batches = CommitLog(spark, f"{folder}/batches")  # one file for each batch name

    def next_value(self) -> int:
        """The smallest number that no batch has."""
        return self.blocks.last()[1].get("end", self.first)

    def _batch_file(self, batch: str) -> str:
        return hashlib.sha256(batch.encode("utf-8")).hexdigest() + ".json"

    def reserved(self, batch: str) -> tuple[int, int] | None:
        """(start, end) of the batch's block, if it has one."""
        folder, name = self.batches.folder, self._batch_file(batch)
        if name not in folder.names():
            return None
        block = json.loads(folder.read(name))
        return block["start"], block["end"]

    def reserve(self, batch: str, n: int) -> int:
        """The first of ``n`` numbers for this batch. The same batch gets the same block
        again; asking for another count under its name is an error."""
        while True:
            block = self.reserved(batch)
            if block is not None:
                if block[1] - block[0] != n:
                    raise ValueError(f"batch {batch!r} has {block[1] - block[0]} numbers, not {n}")
                return block[0]
            number, last = self.blocks.last()
            start = last.get("end", self.first)
            try:
                self.blocks.add(number + 1, {"batch": batch, "start": start, "end": start + n})
            except ConcurrentCommit:
                continue  # another batch was faster: go on behind it
            try:
                self.batches.folder.create(self._batch_file(batch), json.dumps({"start": start, "end": start + n}))
            except ConcurrentCommit:
                continue  # the same batch ran twice at a time: its first block holds, this one is a gap
            return start

    def number(self, df: DataFrame, order_by: Columns[str | Column], batch: str, id_col: str = "row_id",
               num_partitions: int | None = None) -> DataFrame:
        """``df`` with dense ids in ``order_by`` order, from the block of ``batch``. With a
        total order, a retried batch gives every row its old id."""
        order = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order_by]
        return self.number_sorted(by_range(df, order, num_partitions).sortWithinPartitions(*order), batch, id_col)

    def number_sorted(self, df: DataFrame, batch: str, id_col: str = "row_id") -> DataFrame:
        """:meth:`number` for a frame whose partitions are already in global order."""
        numbered = number_sorted_partitions(df, id_col)
        start = self.reserve(batch, numbered.count())
        return numbered.withColumn(id_col, F.col(f"`{id_col}`") + F.lit(start))
