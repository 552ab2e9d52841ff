"""Token ids as ORC files.

Texts are range-partitioned by document id (an id that many rows share is split by
text, equal rows by their number) and sorted, encoded inside the tasks, and
written by Spark's ORC writer: ids are ``array<int>`` columns with
integer run-length encoding, row indexes every ``ROW_INDEX_STRIDE`` rows and a
Bloom filter on ``doc_id``. A file holds a range of ids, so a reader prunes
files, stripes and row groups by the column statistics, and reads stripes in
parallel (ORC splits at stripes).

A row's ``start`` (ids of all documents before it) is its place in its own file
plus the lengths of the files before; only one length per file is summed across
files.

Edge cases: a null or empty text becomes just the end id; rows of a repeated id
stay separate rows, in the order of a hash of the text, and may lie in several
files; null ids come first; an empty table writes
no rows and reads back empty; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from playstats.llm.common import id_text, text_chunks
from playstats.llm.pretokens import PieceCache, byte_bpe, id_bytes, rank_encoder

ROW_INDEX_STRIDE = 10_000
STRIPE_BYTES = 64 << 20
BLOOM_FPP = 0.01

#: Entries of one generation of a worker's cache; two of them take about 150 MB.
CACHE_ENTRIES = 400_000

FILE_SCHEMA = "doc_id bigint, file_no int, file_start bigint, n_tokens int, ids array<int>"

_CACHES: dict[str, PieceCache] = {}


def _ids_cache(vocabulary: str) -> PieceCache:
    """pre-token -> its ids as little-endian 32-bit bytes; one per worker."""
    if vocabulary not in _CACHES:
        bpe = byte_bpe(vocabulary)
        ranks = rank_encoder(bpe)

        def work(piece: str) -> bytes:
            if ranks is None or piece in bpe.special:
                return bpe.piece_bytes(piece)
            return id_bytes(ranks.encode_ordinary(piece))

        _CACHES[vocabulary] = PieceCache(work, limit=CACHE_ENTRIES)
    return _CACHES[vocabulary]


def write_token_orc(documents: DataFrame, path: str, vocabulary: str, end_id: int = 0,
                    id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every whole text, append ``end_id`` and write ORC files to ``path``
    in ascending id order."""
    docs = id_text(documents, id_col, text_col)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, cache, at = byte_bpe(vocabulary), _ids_cache(vocabulary), 0
        for part, texts in text_chunks(batches):
            blobs = []
            for text in texts:
                pieces = bpe.pieces(text)
                blobs.append(id_bytes(bpe.library_ids(text)) if pieces is None
                             else b"".join(map(cache.__getitem__, pieces)))
                blobs.append(int(end_id).to_bytes(4, "little"))
                cache.trim()
            sizes = np.array([len(a) // 4 + 1 for a in blobs[::2]], np.int64)
            offsets = np.concatenate([[0], np.cumsum(sizes)])
            ids = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)),
                                           pa.array(np.frombuffer(b"".join(blobs), "<i4")))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), part.column("file_no"),
                 pa.array(at + offsets[:-1]), pa.array(sizes.astype(np.int32)), ids],
                names=["doc_id", "file_no", "file_start", "n_tokens", "ids"])
            at += int(offsets[-1])

    # rows of one id may be a third of the table; the row number parts rows that are equal
    order = [F.col("doc_id").asc_nulls_first(), F.col("_hash"), F.col("_row")]
    (docs.withColumn("_hash", F.xxhash64("text")).withColumn("_row", F.monotonically_increasing_id())
     .repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("_hash", "_row")
     .withColumn("file_no", F.spark_partition_id())
     .mapInArrow(encode, FILE_SCHEMA)
     .write.option("compression", "zstd")
     .option("orc.stripe.size", STRIPE_BYTES)
     .option("orc.row.index.stride", ROW_INDEX_STRIDE)
     .option("orc.bloom.filter.columns", "doc_id")
     .option("orc.bloom.filter.fpp", BLOOM_FPP)
     .orc(path))


def read_token_orc(spark: SparkSession, path: str) -> DataFrame:
    """The files' rows with the global ``start``: (doc_id, start, n_tokens, ids)."""
    rows = spark.read.schema(FILE_SCHEMA).orc(path)
    return _with_start(rows, rows).select("doc_id", "start", F.col("n_tokens").cast("bigint").alias("n_tokens"), "ids")


def _with_start(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """``rows`` (file_no, file_start, ...) of the ``stored`` files with ``start``."""
    # one row per file; files are ordered by the ids they hold
    files = stored.groupBy("file_no").agg(F.sum("n_tokens").alias("_n"), F.min("doc_id").alias("_first"),
                                        F.count("doc_id").alias("_ids"))
    before = Window.orderBy(F.col("_first").asc_nulls_first(), "file_no").rowsBetween(
        Window.unboundedPreceding, -1)
    files = files.select("file_no", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    # a row per file, and files are as many as write partitions: a bounded broadcast
    return (rows.join(F.broadcast(files), "file_no")
            .withColumn("start", F.col("_before") + F.col("file_start")).drop("_before"))


def token_digest(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the files at ``path``; length and
    checksum are taken from the ids themselves, in the task that reads them."""
    rows = spark.read.schema(FILE_SCHEMA).orc(path)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            offsets = np.asarray(lists.offsets)
            values = memoryview(np.ascontiguousarray(np.asarray(lists.values), "<i4")).cast("B")
            crcs = [zlib.crc32(values[4 * a:4 * b]) for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("file_no"), batch.column("file_start"),
                 pa.array(np.diff(offsets).astype(np.int64)), pa.array(crcs, pa.int64())],
                names=["doc_id", "file_no", "file_start", "n_tokens", "ids_crc32"])

    digests = rows.select("doc_id", "file_no", "file_start", "ids").mapInArrow(
        digest, "doc_id bigint, file_no int, file_start bigint, n_tokens bigint, ids_crc32 bigint")
    return _with_start(digests, rows).select("doc_id", "start", "n_tokens", "ids_crc32")
