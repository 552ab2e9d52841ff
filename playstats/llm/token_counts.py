"""Token counts by a map-side two-tier lookup.

1. One pass counts pre-tokens with a mergeable heavy-hitter summary (Misra and
   Gries) per task. The summaries, of fixed size, merge in a tree; no pre-token
   is shuffled. The most frequent ones with their token counts become the first
   tier: a table of at most ``frequent`` entries, broadcast.
2. The second pass looks up every pre-token of every whole text in that table;
   misses are encoded by the library and kept in the worker's bounded cache,
   the second tier.

The first tier is only an accelerator: whatever it holds, the counts are those
of the library.

Edge cases: a null or empty text has 0 bytes and 0 tokens; a repeated row or a
repeated or null id gives one output row per input row; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import uuid
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from playstats.llm.common import id_text, text_chunks
from playstats.llm.pretokens import PieceCache, byte_bpe

#: Entries of the broadcast table. With pieces of at most PIECE_CHARS characters
#: it stays below about 6 MB.
FREQUENT = 32_768
PIECE_CHARS = 40

OUT_SCHEMA = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"


def shrink(counts: Counter, size: int) -> Counter:
    """Misra-Gries reduction: subtract the (size+1)-th largest count from all and
    keep what stays positive. A piece more frequent than total/size survives."""
    if len(counts) <= size:
        return counts
    cut = sorted(counts.values(), reverse=True)[size]
    return Counter({p: n - cut for p, n in counts.items() if n > cut})


def merge_summaries(a: dict, b: dict, size: int) -> dict:
    both = Counter(a)
    both.update(b)
    return dict(shrink(both, size))


def frequent_pieces(docs: DataFrame, vocabulary: str, size: int = FREQUENT) -> dict[str, int]:
    """pre-token -> number of tokens for the frequent pre-tokens of all ``docs``."""

    def summarise(rows) -> Iterator[dict]:
        bpe, counts = byte_bpe(vocabulary), Counter()
        for row in rows:
            counts.update(p for p in bpe.pieces(row.text) or () if len(p) <= PIECE_CHARS)
            if len(counts) > 8 * size:
                counts = shrink(counts, size)
        yield dict(shrink(counts, size))

    merge = functools.partial(_merge, size=size)
    summary = docs.select("text").rdd.mapPartitions(summarise).treeAggregate({}, merge, merge, depth=3)
    bpe = byte_bpe(vocabulary)
    return {p: len(bpe.piece_ids(p)) for p in summary}


def _merge(a: dict, b: dict, size: int) -> dict:
    return merge_summaries(a, b, size)


def token_counts(documents: DataFrame, vocabulary: str, limit: int = 1024, id_col: str = "doc_id",
                 text_col: str = "text", frequent: int = FREQUENT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row; ``over_limit``:
    more than ``limit`` tokens. ``vocabulary``: path of a byte-level BPE file."""
    docs = id_text(documents, id_col, text_col)
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(frequent_pieces(docs, vocabulary, frequent))
    run = uuid.uuid4().hex  # names this table in the workers' caches

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(vocabulary)
        cache = _cache(vocabulary, run, table)
        for part, texts in text_chunks(batches):
            n_bytes, n_tokens = [], []
            for text in texts:
                pieces = bpe.pieces(text)
                n_bytes.append(len(text.encode("utf-8")))
                n_tokens.append(len(bpe.library_ids(text)) if pieces is None
                                else sum(map(cache.__getitem__, pieces)))
                cache.trim()
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), pa.array(n_bytes, pa.int64()),
                 pa.array(n_tokens, pa.int64()), pa.array([n > limit for n in n_tokens], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.mapInArrow(count, OUT_SCHEMA)


_CACHES: dict[str, tuple[str, PieceCache]] = {}


def _cache(vocabulary: str, run: str, table) -> PieceCache:
    """The worker's cache for this broadcast table; a newer table replaces it."""
    known = _CACHES.get(vocabulary)
    if known is None or known[0] != run:
        bpe = byte_bpe(vocabulary)
        known = _CACHES[vocabulary] = (run, PieceCache(lambda p: len(bpe.piece_ids(p)), table.value))
    return known[1]
