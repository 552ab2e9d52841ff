"""Cross-tokenizer alignment by merge-path partitioning.

Every text is encoded by two tokenizers, A (byte-level BPE) and B (BPE over
pieces). Both cut the same bytes, so each token is known by the byte offset at
which it ends, and the two ascending lists of ends are merged:

1. The texts of a chunk lie one behind the other in one byte range, so one long
   text and many short ones are the same work. Diagonal binary searches cut the
   merge of the two lists into pieces of ``PIECE`` tokens each, whatever the
   lengths of the texts.
2. Each piece is merged by itself and emits the ends that both lists have. Where
   a cut fell between two equal ends, the neighbours are stitched.
3. The common ends cut the tokens into groups, and link the A token and the B
   token that end there.

How often a pair of ids is linked in the whole corpus is counted from the stored
links: each task reduces them to (pair, count) rows before the shuffle. The most
frequent pairs, ``frequent`` of them at most, go to the tasks as a table; links of
all other pairs are looked up by a join. Both ways give the same values.

Edge cases: a text that is null, empty, or not given back byte for byte by both
tokenizers has no tokens: zeros, and '' for the groups. Repeated rows and
repeated or null ids give one output row per input row; pairs of equal counts tie
for the best and all of them are best; an empty table gives an empty result;
other columns are ignored. A very long text is cut into as many pieces as its
tokens need.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playstats.llm.common import id_text, stored, text_chunks
from playstats.llm.pretokens import (
    BYTE_LEVEL_PATTERN,
    ByteBpe,
    PieceCache,
    as_symbols,
    byte_symbols,
    has_unassigned,
    id_bytes,
    splitter,
)

#: Tokens of both lists that one piece merges.
PIECE = 1 << 16

#: Links that a task reduces to (pair, count) at a time (16 MB of ids), and that it
#: looks up at a time (some 25 MB with all that is derived from them).
COUNT_LINKS, LOOK_UP_LINKS = 1 << 22, 1 << 19

#: Pairs in the table that goes to every task: 4 + 8 + 1 bytes each, 3.4 MB.
FREQUENT = 1 << 18

ALIGNED_SCHEMA = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, {groups} string, links array<int>"


class Pair:
    """Both tokenizers of a worker, with the bytes of every token."""

    def __init__(self, path_a: str, path_b: str):
        self.a = ByteBpe(path_a)
        self.a.library.no_truncation()
        self.a.library.no_padding()
        self.a.library.encode_special_tokens = True
        # special strings are plain text here: only the pattern splits
        self.split = splitter(BYTE_LEVEL_PATTERN)
        self.ids_a = PieceCache(lambda piece: id_bytes([t.id for t in self.a.model.tokenize(as_symbols(piece))]))
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        back = {s: bytes([b]) for b, s in byte_symbols().items()}
        self.n_a = max(self.a.library.get_vocab(with_added_tokens=True).values()) + 1
        self.n_b = self.b.get_piece_size()
        self.bytes_a = [b""] * self.n_a
        for symbols, i in self.a.library.get_vocab(with_added_tokens=True).items():
            self.bytes_a[i] = b"".join(back.get(s, s.encode("utf-8")) for s in symbols)
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode("utf-8")
                        for i in range(self.n_b) for p in [self.b.id_to_piece(i)]]
        self.size_a, self.size_b = (np.array([len(t) for t in x], np.int64) for x in (self.bytes_a, self.bytes_b))
        # an id as text, with the sign behind it: A inside and at the end of a group, B likewise
        marks = [(self.n_a, b","), (self.n_a, b"|"), (self.n_b, b","), (self.n_b, b";")]
        self.texts = np.array([b"%d%s" % (i, mark) for n, mark in marks for i in range(n)], object)

    def encode_a(self, text: str) -> np.ndarray:
        whole = " " + text
        if has_unassigned(whole):
            return np.array(self.a.library.encode(whole, add_special_tokens=False).ids, np.int64)
        found = b"".join(map(self.ids_a.__getitem__, self.split(whole)))
        self.ids_a.trim()
        return np.frombuffer(found, "<u4").astype(np.int64)

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(A ids, B ids) of each text; none where a tokenizer loses bytes."""
        none = np.zeros(0, np.int64)
        out = []
        for text, ids_b in zip(texts, self.b.encode(texts, num_threads=1) if texts else []):
            ids_a, ids_b = self.encode_a(text) if text else none, np.array(ids_b, np.int64)
            whole = (" " + text).encode("utf-8")
            same = text and all(b"".join(map(table.__getitem__, ids.tolist())) == whole
                                for table, ids in ((self.bytes_a, ids_a), (self.bytes_b, ids_b)))
            out.append((ids_a, ids_b) if same else (none, none))
        return out


@functools.lru_cache(maxsize=2)
def tokenizer_pair(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


def merge_path(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """Where the diagonals 0, ``piece``, 2 ``piece``, ... cut the merge of two
    ascending arrays (equal values: ``a`` first): the first i items of ``a`` and j
    of ``b`` come before a cut. One binary search for all diagonals at once."""
    total = len(a) + len(b)
    diagonal = np.append(np.arange(0, total, piece), total)
    low, high = np.maximum(0, diagonal - len(b)), np.minimum(diagonal, len(a))
    while (open_ := np.flatnonzero(low < high)).size:
        mid = (low[open_] + high[open_]) // 2
        first = a[mid] <= b[diagonal[open_] - 1 - mid]
        low[open_[first]] = mid[first] + 1
        high[open_[~first]] = mid[~first]
    return low, diagonal - low


def common_ends(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and ``b`` (ascending, no repeats) of the values that both have."""
    cut_a, cut_b = merge_path(a, b, piece)
    at_a, at_b = [], []
    for i, i_end, j, j_end in zip(cut_a[:-1], cut_a[1:], cut_b[:-1], cut_b[1:]):
        if i < i_end and j < j_end:
            place = np.searchsorted(b[j:j_end], a[i:i_end])
            hit = np.flatnonzero(b[np.minimum(place + j, j_end - 1)] == a[i:i_end])
            at_a.append(hit + i)
            at_b.append(place[hit] + j)
        # the cut behind this piece may part two equal ends
        if 0 < i_end and j_end < len(b) and a[i_end - 1] == b[j_end]:
            at_a.append(np.array([i_end - 1]))
            at_b.append(np.array([j_end]))
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *at_a]), np.concatenate([none, *at_b])


def _group_texts(pair: Pair, ids_a, ids_b, last_a, last_b, upto: np.ndarray) -> list[bytes]:
    """`a1,a2|b1;a3|b2,b3` of each text; ``upto``: tokens of both kinds up to its end."""
    sizes_a, sizes_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
    before_b, through_a = np.repeat(last_b + 1 - sizes_b, sizes_a), np.repeat(last_a + 1, sizes_b)
    row = np.empty(len(ids_a) + len(ids_b), np.int64)
    mark_a, mark_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
    mark_a[last_a], mark_b[last_b] = pair.n_a, pair.n_b
    row[np.arange(len(ids_a)) + before_b] = ids_a + mark_a
    row[np.arange(len(ids_b)) + through_a] = 2 * pair.n_a + ids_b + mark_b
    words = pair.texts[row].tolist()
    return [b"".join(words[start:end])[:-1] for start, end in zip([0, *upto[:-1].tolist()], upto.tolist())]


def align_chunk(pair: Pair, texts: list[str], digest: bool, piece: int = PIECE):
    """(n_a, n_b, n_groups, groups, offsets of the links, links) of a few texts."""
    encoded = pair.encode(texts)
    n_a, n_b = (np.array([len(e[k]) for e in encoded], np.int64) for k in (0, 1))
    ids_a, ids_b = (np.concatenate([np.zeros(0, np.int64), *[e[k] for e in encoded]]) for k in (0, 1))
    ends_a, ends_b = np.cumsum(pair.size_a[ids_a]), np.cumsum(pair.size_b[ids_b])
    last_a, last_b = common_ends(ends_a, ends_b, piece)
    # a text's last tokens end together, so no group reaches over two texts
    groups_upto = np.searchsorted(last_a, np.cumsum(n_a))
    texts_out = _group_texts(pair, ids_a, ids_b, last_a, last_b, np.cumsum(n_a) + np.cumsum(n_b))
    if digest:
        groups = [hashlib.sha256(g).hexdigest() if g else "" for g in texts_out]
    else:
        groups = [g.decode("ascii") for g in texts_out]
    links = (ids_a[last_a] * pair.n_b + ids_b[last_b]).astype(np.int32)
    return n_a, n_b, np.diff(groups_upto, prepend=0), groups, np.append(0, groups_upto), links


def align(documents: DataFrame, path_a: str, path_b: str, digest: bool = False, id_col: str = "doc_id",
          text_col: str = "text", piece: int = PIECE) -> DataFrame:
    """One row per document: (doc_id, n_a, n_b, n_groups, groups, links). ``groups``
    lists the ids of both tokenizers group by group; with ``digest`` its SHA-256
    stands in ``groups_sha256`` instead. ``links`` has one entry per group:
    A id * size of B's vocabulary + B id."""
    name = "groups_sha256" if digest else "groups"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenizer_pair(path_a, path_b)
        for part, texts in text_chunks(batches):
            n_a, n_b, n_groups, groups, offsets, links = align_chunk(pair, texts, digest, piece)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), pa.array(n_a), pa.array(n_b), pa.array(n_groups),
                 pa.array(groups, pa.string()),
                 pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(links))],
                names=["doc_id", "n_a", "n_b", "n_groups", name, "links"])

    return id_text(documents, id_col, text_col).mapInArrow(work, ALIGNED_SCHEMA.format(groups=name))


def _lists(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, values) of a list column, offsets from 0."""
    lists = batch.column(column)
    offsets = np.asarray(lists.offsets).astype(np.int64)
    return offsets - offsets[0], np.asarray(lists.values)[offsets[0]:offsets[-1]]


def _slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The batches in slices with about ``limit`` list values, one row at least."""
    for batch in batches:
        upto, at = np.asarray(batch.column(column).offsets), 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(upto, upto[at] + limit, side="right")) - 1)
            yield batch.slice(at, end - at)
            at = end


def pair_counts(aligned: DataFrame, n_b: int) -> DataFrame:
    """(pair, n, best) of every linked pair of the corpus: how often it is linked, and
    whether no other pair of its B id is linked more often."""

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def counted():
            pairs, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n.astype(np.int64))], names=["pair", "n"])

        for batch in batches:
            values = _lists(batch, "links")[1]
            for at in range(0, len(values), COUNT_LINKS):
                held.append(values[at:at + COUNT_LINKS].copy())
                size += len(held[-1])
                if size >= COUNT_LINKS:
                    yield counted()
                    held, size = [], 0
        if size:
            yield counted()

    counts = stored(aligned.select("links").mapInArrow(reduce, "pair int, n bigint")
                    .groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")
    # as many rows as B has ids
    most = counts.groupBy((F.col("pair") % n_b).alias("_b")).agg(F.max("n").alias("_most"))
    return (counts.join(F.broadcast(most), F.col("pair") % n_b == F.col("_b"))
            .select("pair", "n", (F.col("n") == F.col("_most")).alias("best")))


def _least_count(counts: DataFrame, frequent: int) -> int:
    """The smallest power of two that at most ``frequent`` pairs reach; from one row
    per power, so no global order of the pairs is needed."""
    powers = {r["p"]: r["k"] for r in counts.groupBy(F.floor(F.log2("n")).alias("p")).agg(
        F.count("*").alias("k")).collect()}
    least, held = 63, 0
    while least > 0 and held + powers.get(least - 1, 0) <= frequent:
        least -= 1
        held += powers.get(least, 0)
    return 1 << least if least < 63 else (1 << 63) - 1


def link_scores(aligned: DataFrame, n_b: int, frequent: int = FREQUENT) -> DataFrame:
    """The rows of :func:`align` (stored, so that every scan gives the same) without
    their links, with n_links, n_best and count_sum."""
    spark = aligned.sparkSession
    counts = stored(pair_counts(aligned, n_b), "pair-table")
    top = counts.filter(F.col("n") >= _least_count(counts, frequent)).select("pair", "n", "best").toArrow()
    order = np.argsort(top.column("pair").to_numpy())
    table = spark.sparkContext.broadcast(tuple(top.column(c).to_numpy()[order] for c in ("pair", "n", "best")))
    keep = [c for c in aligned.columns if c != "links"]

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n, best = table.value
        for batch in _slices(batches, "links", LOOK_UP_LINKS):
            offsets, values = _lists(batch, "links")
            place = np.minimum(np.searchsorted(pairs, values), max(len(pairs) - 1, 0))
            known = pairs[place] == values if len(pairs) else np.zeros(len(values), bool)
            gain, good = np.zeros(len(values), np.int64), np.zeros(len(values), np.int64)
            gain[known], good[known] = n[place[known]], best[place[known]]
            missed = np.append(0, np.cumsum(~known))
            upto = [np.append(0, np.cumsum(x))[offsets] for x in (good, gain)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("row", *keep)], pa.array(np.diff(offsets)),
                 *[pa.array(np.diff(x)) for x in upto],
                 pa.ListArray.from_arrays(pa.array(missed[offsets].astype(np.int32)), pa.array(values[~known]))],
                names=["row", *keep, "n_links", "_best", "_sum", "_missed"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in aligned.schema if f.name in keep)
    rows = stored(aligned.withColumn("row", F.monotonically_increasing_id()).mapInArrow(
        look_up, f"row bigint, {kinds}, n_links bigint, _best bigint, _sum bigint, _missed array<int>"), "link-scores")
    # pairs outside the table are linked no more often than its last one, so no key is hot
    rest = (rows.select("row", F.explode("_missed").alias("pair")).groupBy("row", "pair").agg(F.count("*").alias("k"))
            .join(counts, "pair")
            .groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("k")).otherwise(0)).alias("_best2"),
                                F.sum(F.col("k") * F.col("n")).alias("_sum2")))
    return rows.join(rest, "row", "left").select(
        *keep, "n_links", (F.col("_best") + F.coalesce("_best2", F.lit(0))).alias("n_best"),
        (F.col("_sum") + F.coalesce("_sum2", F.lit(0))).alias("count_sum"))


def token_alignment(documents: DataFrame, path_a: str, path_b: str, digest: bool = False,
                    frequent: int = FREQUENT) -> DataFrame:
    """Alignment of every document with the corpus-wide counts of its links."""
    aligned = stored(align(documents, path_a, path_b, digest), "aligned")
    n_b = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    return link_scores(aligned, n_b, frequent)
