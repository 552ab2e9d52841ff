"""Shards of equal bytes by histogram sort.

All rows have a place in one order (:func:`sort_key`: by the digest of the text,
so equal texts lie together and sources are mixed, then by id). The shards are
ranges of that order with the same number of bytes:

1. One pass over the texts leaves a small key table (key, size).
2. Candidate boundaries ("probes") are set between the keys. Every task counts the
   exact bytes and rows of its keys from one probe to the next; the sums show
   between which probes each wanted splitter lies. Only these intervals get new
   probes, evenly spaced from their first to their last key, round after round,
   until each splitter meets its tolerance. The number of probes depends on the
   number of splitters alone, and every round divides a key range by ``PROBES``, so
   the rounds are few however the keys lie.
3. The rows are exchanged once, each straight to the partition of its range, and
   sorted there. The counts below the splitters are known from step 2, so a row's
   slot is its place in its own partition plus a known offset.

A shard consists of several ranges ("pieces"), so no task holds a whole shard. A
row repeated so often that a splitter parts its copies is reduced to (row, copies)
before the exchange; the copies are dealt out by number, and made again behind it.

With a tolerance of 0, a row belongs to the shard that holds its middle byte.

Edge cases: a null text has size 1 and stays null in the files; repeated rows stay
separate rows with slots of their own; null ids come first among equal texts; fewer
rows than shards, or a row larger than a shard, leave shards empty; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playstats.llm.common import shared_path, stored

#: md5 of the text, whether there is one, whether there is an id, the id.
KEY_BYTES = 16 + 1 + 1 + 8

#: Probes for each interval and round, and for each splitter where several share one.
PROBES, PROBES_SHARED = 64, 16

#: How far, in parts of a piece, a boundary inside a shard may be from its place.
PIECE_SLACK = 0.05

SHARDS_SCHEMA = "doc_id bigint, text string, slot bigint, shard int"

_ALL = 1 << 62


def sort_key(text: Column, doc_id: Column) -> Column:
    """``KEY_BYTES`` bytes whose order is the order of the rows. Rows with equal keys
    have equal ids and texts."""
    # with the sign bit turned, the bytes of an integer sort as the integer does
    number = F.lpad(F.hex(doc_id.bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")

    def present(c: Column) -> Column:
        return F.when(c.isNull(), "00").otherwise("01")

    return F.unhex(F.concat(F.md5(F.coalesce(text, F.lit(""))), present(text), present(doc_id),
                            F.coalesce(number, F.lit("0" * 16))))


def row_size(text: Column) -> Column:
    return F.octet_length(F.coalesce(text, F.lit(""))).cast("long") + 1


def _fixed(column: pa.Array, width: int) -> np.ndarray:
    """A binary column whose values all have ``width`` bytes, as one array."""
    if len(column) == 0:
        return np.zeros(0, f"S{width}")
    offsets = np.frombuffer(column.buffers()[1], "<i4")[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    return np.ascontiguousarray(data).view(f"S{width}")


def _binary(keys: np.ndarray) -> pa.Array:
    # numpy drops zero bytes at the end
    return pa.array([k.ljust(KEY_BYTES, b"\0") for k in keys.tolist()], pa.binary())


def _number(key: bytes) -> int:
    return int.from_bytes(key, "big")


def _key(number: int) -> bytes:
    return number.to_bytes(KEY_BYTES, "big")


def count_between(keys: DataFrame, edges: list[bytes]) -> dict[int, tuple]:
    """Number i -> (bytes, rows, first key, last key) of the keys from edge i - 1
    (included) to edge i. Intervals without keys are absent."""
    wanted = np.array(edges, f"S{KEY_BYTES}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            own, sizes = _fixed(batch.column("key"), KEY_BYTES), np.asarray(batch.column("size"), np.int64)
            order = np.argsort(own)
            own, sizes = own[order], sizes[order]
            at = np.searchsorted(wanted, own, side="right")
            first = np.flatnonzero(np.diff(at, prepend=-1))
            last = np.append(first[1:], len(at)) - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(at[first].astype(np.int32)), pa.array(np.add.reduceat(sizes, first)),
                 pa.array(last - first + 1), _binary(own[first]), _binary(own[last])],
                names=["at", "bytes", "n", "low", "high"])

    # one row for each interval
    found = (keys.select("key", "size").mapInArrow(count, "at int, bytes bigint, n bigint, low binary, high binary")
             .groupBy("at").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"),
                                F.min("low").alias("low"), F.max("high").alias("high")).collect())
    return {r["at"]: (r["bytes"], r["n"], bytes(r["low"]), bytes(r["high"])) for r in found}


@dataclass(frozen=True, order=True)
class Cut:
    """A splitter. Left of it lie all rows with smaller keys and the first ``copies`` of
    the ``of`` rows with its own key: ``n_rows`` rows with ``n_bytes`` bytes."""

    key: bytes
    copies: int
    n_bytes: int
    n_rows: int
    of: int = 0


@dataclass
class Search:
    """One splitter's interval: the keys from ``low`` to ``high``, with ``inside`` bytes
    and ``rows``; ``n_bytes`` and ``n_rows`` lie below. The target is a number of bytes
    times ``ranges``, so nothing is rounded."""

    target: int
    tolerance: float
    ranges: int
    low: bytes
    high: bytes
    n_bytes: int
    n_rows: int
    inside: int
    rows: int

    def cut(self) -> Cut | None:
        left = self.target - self.n_bytes * self.ranges
        right = self.inside * self.ranges - left
        if self.low == self.high:  # copies of one row: left are those whose middle lies before the target
            size = self.inside // self.rows * self.ranges
            copies = min(self.rows, max(0, -(-(2 * left - size) // (2 * size))))
            return Cut(self.low, copies, self.n_bytes + copies * (size // self.ranges), self.n_rows + copies, self.rows)
        if min(left, right) <= self.tolerance * self.ranges:
            if left <= right:
                return Cut(self.low, 0, self.n_bytes, self.n_rows)
            return Cut(self.high, _ALL, self.n_bytes + self.inside, self.n_rows + self.rows)
        return None

    def probes(self, many: int) -> list[bytes]:
        low, high = _number(self.low), _number(self.high)
        return [_key(low + (high - low) * k // many) for k in range(many + 1)] + [_key(high + 1)]

    def narrow(self, edges: list[bytes], counted: dict[int, tuple]) -> None:
        """To that interval between two edges in which the target lies."""
        n_bytes, n_rows = self.n_bytes, self.n_rows
        # interval i begins with edge i - 1; the last one begins with the old last key
        for i in range(bisect_left(edges, self.low) + 1, bisect_left(edges, self.high) + 2):
            if i not in counted:
                continue
            inside, rows, low, high = counted[i]
            if (n_bytes + inside) * self.ranges >= self.target:
                self.low, self.high, self.n_bytes, self.n_rows = low, high, n_bytes, n_rows
                self.inside, self.rows = inside, rows
                return
            n_bytes, n_rows = n_bytes + inside, n_rows + rows


def splitters(keys: DataFrame, shards: int, pieces: int, tolerance: float = 0.0,
              probes: int = PROBES) -> tuple[list[Cut], int]:
    """The splitters of the key table (key, size) into ``shards`` shards of ``pieces``
    pieces each, in order, and the number of rounds. ``tolerance``: how far, in parts
    of a shard, a shard's boundary may be from equal bytes."""
    whole = count_between(keys, [])
    if not whole:
        return [], 0
    n_bytes, n_rows, low, high = whole[0]
    ranges, rounds = shards * pieces, 0
    search = {i: Search(i * n_bytes, n_bytes / ranges * (PIECE_SLACK if i % pieces else tolerance * pieces), ranges,
                        low, high, 0, 0, n_bytes, n_rows) for i in range(1, ranges)}
    cuts: dict[int, Cut] = {}
    while True:
        cuts |= {i: c for i, s in search.items() if i not in cuts and (c := s.cut())}
        wanted = [s for i, s in search.items() if i not in cuts]
        if not wanted:
            return sorted(cuts.values()), rounds
        rounds += 1
        # splitters in one interval share their probes
        same = {s.low: s for s in wanted}
        many = {low: sum(s.low == low for s in wanted) for low in same}
        edges = sorted({p for low, s in same.items() for p in s.probes(max(probes, PROBES_SHARED * many[low]))})
        span = F.col("key").between(F.lit(min(same)), F.lit(max(s.high for s in wanted)))
        counted = count_between(keys.filter(span), edges)
        for s in wanted:
            s.narrow(edges, counted)


def _piece_of(cuts: list[Cut]):
    """Key -> number of the cuts that lie left of the (first) row with this key."""
    edges = np.array([c.key + (b"\1" if c.copies else b"\0") for c in cuts], f"S{KEY_BYTES + 1}")

    @F.arrow_udf("int")
    def piece(key: pa.Array) -> pa.Array:
        own = np.zeros((len(key), KEY_BYTES + 1), np.uint8)
        own[:, :KEY_BYTES] = _fixed(key, KEY_BYTES).view(np.uint8).reshape(-1, KEY_BYTES)
        return pa.array(np.searchsorted(edges, own.view(f"S{KEY_BYTES + 1}").ravel(), side="right").astype(np.int32))

    return piece


def _dealt_copies(spark: SparkSession, cuts: list[Cut]) -> DataFrame | None:
    """(key, piece, copies) of the rows whose copies lie on both sides of a cut; at
    most a row for each cut and one more for each such row. None: there are none."""
    parted = {c.key: c.of for c in cuts if 0 < c.copies < c.of}
    rows = []
    for key, of in parted.items():
        first = sum(c.key < key for c in cuts)
        own = [c.copies for c in cuts if c.key == key]
        steps = [0, *(min(k, of) for k in own), of]
        rows += [(bytearray(key), first + i, b - a) for i, (a, b) in enumerate(zip(steps, steps[1:])) if b > a]
    return spark.createDataFrame(rows, "key binary, piece int, copies bigint") if rows else None


def shard_rows(documents: DataFrame, shards: int, tolerance: float = 0.0, id_col: str = "doc_id",
               text_col: str = "text", probes: int = PROBES) -> DataFrame:
    """(doc_id, text, slot, shard) of every row, sorted inside its partition, each
    partition a piece of one shard."""
    spark = documents.sparkSession
    keyed = documents.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    keyed = keyed.withColumn("key", sort_key(F.col("text"), F.col("doc_id")))
    keys = stored(keyed.select("key", row_size(F.col("text")).alias("size")), "shard-keys")
    pieces = -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // shards)
    cuts, _ = splitters(keys, shards, pieces, tolerance, probes)
    begins = [0, *(c.n_rows for c in cuts)]
    begins = [b - begins[i - i % pieces] for i, b in enumerate(begins)]  # counted from the shard's first row
    rows = keyed.select("doc_id", "text", "key", _piece_of(cuts)("key").alias("piece"), F.lit(1).cast("long").alias("copies"))
    dealt = _dealt_copies(spark, cuts)
    if dealt is not None:
        # as few keys as cuts; the groups shrink to one row in each task before the shuffle
        few = F.broadcast(dealt)
        many = keyed.join(F.broadcast(dealt.select("key").distinct()), "key", "left_semi")
        one = many.groupBy("key").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"))
        rows = rows.join(F.broadcast(dealt.select("key").distinct()), "key", "left_anti").select(*rows.columns).unionByName(
            one.join(few, "key").select(*rows.columns))
    placed = (rows.withColumn("shard", F.floor(F.col("piece") / pieces).cast("int"))
              .repartitionById(shards * pieces, F.col("piece")).sortWithinPartitions("shard", "key"))
    if dealt is not None:
        placed = placed.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    # the low 33 bits count the rows of the partition, which is one piece
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    begin = F.element_at(F.array(*[F.lit(b).cast("long") for b in begins]), F.col("piece") + 1)
    return placed.select("doc_id", "text", (begin + place).alias("slot"), "shard")


def write_shards(documents: DataFrame, path: str, shards: int, tolerance: float = 0.0, id_col: str = "doc_id",
                 text_col: str = "text") -> None:
    """Writes the rows to ``path``, one folder of files for each shard."""
    shard_rows(documents, shards, tolerance, id_col, text_col).write.partitionBy("shard").parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SHARDS_SCHEMA).parquet(path)


def shard_digest(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of the files' rows."""
    return read_shards(spark, path).select(
        "doc_id", row_size(F.col("text")).alias("size"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def sharded(documents: DataFrame, shards: int = 16, tolerance: float = 0.0) -> DataFrame:
    """Writes the shards to a new shared folder and reads them back."""
    path = shared_path(documents.sparkSession, "shards")
    write_shards(documents, path, shards, tolerance)
    return shard_digest(documents.sparkSession, path)
