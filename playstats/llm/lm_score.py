"""Cross-entropy difference of a target and a background language model.

Both models are bigram models over one shared vocabulary, counted over whole
texts and smoothed alike; they differ only in their documents: the target
model's are the rows given as such (here: those labelled good), the background
model's are all rows. A document's score is the mean over its tokens of
``log p_background - log p_target``: below zero, it is closer to the target.

* Vocabulary: the ``words`` most frequent words of all documents. A word outside
  it is the token of its last byte, so no token is unknown. The size is a
  parameter of the model, not of the data: ``words + 256`` tokens.
* Counts: per task one dense table of token pairs, whose non-zero cells are
  summed by a Spark aggregate over all tasks. So counting covers every token.
* Whole vocabulary (``words=None``, as registered): every word is a token of its own,
  known by a 64-bit hash. The counts are Spark tables that grow with the corpus: chunks
  of texts send their distinct words and pairs to be summed and get the sums back.
  Nothing but totals is collected. The background is matched to the target in
  size: its PRIOR is larger by the ratio of their tokens, so that both models are
  smoothed as if they had been counted over equally many.
* Smoothing: p(w | c) = (n(c, w) + PRIOR * p(w)) / (n(c) + PRIOR), with
  p(w) = (n(w) + 1) / (N + tokens). A document's first token follows a start mark.
* Scoring: the two tables of log probabilities (at most 8 bytes * tokens^2 each,
  19 MB by default) are broadcast; texts are not shuffled again.

Edge cases: null or empty text, or no word: 0 tokens and 0.0 in all columns.
Without any target row the target model is uniform. Repeated rows and ids are
scored row by row and counted as often as they occur. An empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playstats.llm import fingerprints
from playstats.llm.common import id_text, stored, text_chunks
from playstats.llm.textops import span_hash, word_spans, words_of

WORDS = 1280
PRIOR = 50.0
#: The context of a text's first word.
START = 0
#: Bytes of text in a chunk, whose distinct words and pairs are counted together (whole vocabulary).
CHUNK = 8 << 20
#: Bytes of text whose words and pairs meet in one bucket of hashes, on average.
BUCKET = 16 << 20


class Vocabulary:
    """Numbers of words: a vocabulary word's place, or len(words) + last byte."""

    def __init__(self, words: list[str]):
        self.size = len(words) + 256
        self.start = self.size  # context of a text's first token
        hashes = np.concatenate([np.zeros(0, np.uint64), *[_hash_one(w) for w in words]])
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        self.known = len(words)

    def cells(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(context * size + token for every token, first token of each text)."""
        data, starts, ends, first = word_spans(texts)
        hashes = span_hash(data, starts, ends - starts)
        token = data[ends - 1].astype(np.int64) + self.known
        if self.known:
            at = np.minimum(np.searchsorted(self.hashes, hashes), self.known - 1)
            token = np.where(self.hashes[at] == hashes, self.order[at], token)
        context = np.concatenate([[self.start], token[:-1]]) if len(token) else token
        context[first[:-1][first[:-1] < len(token)]] = self.start
        return context * self.size + token, first


def _hash_one(word: str) -> np.ndarray:
    data, starts, ends, _ = word_spans([word])
    return span_hash(data, starts, ends - starts)


def vocabulary(docs: DataFrame, words: int = WORDS) -> Vocabulary:
    """The most frequent words of all texts; ties in the order of the words."""
    counts = (docs.select(F.explode(fingerprints.words(F.col("text"))).alias("word"))
              .groupBy("word").agg(F.count(F.lit(1)).alias("n")))
    top = counts.orderBy(F.desc("n"), "word").limit(words)
    return Vocabulary([r["word"] for r in top.collect()])


def pair_counts(flagged: DataFrame, vocab: Vocabulary) -> DataFrame:
    """(cell, background, target) summed over all rows (text, target)."""
    shared = flagged.sparkSession.sparkContext.broadcast(vocab)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = shared.value
        cells = (vocab.size + 1) * vocab.size
        background = target = None
        for part, texts in text_chunks(batches):
            if background is None:
                background, target = np.zeros(cells, np.int64), np.zeros(cells, np.int64)
            at, first = vocab.cells(texts)
            marked = np.repeat(np.array(part.column("target").to_pylist(), bool), np.diff(first))
            np.add.at(background, at, 1)
            np.add.at(target, at[marked], 1)
        if background is not None:
            at = np.flatnonzero(background)
            for k in range(0, len(at), 1 << 17):
                some = at[k:k + (1 << 17)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some.astype(np.int32)), pa.array(background[some]), pa.array(target[some])],
                    names=["cell", "background", "target"])

    return (flagged.mapInArrow(count, "cell int, background bigint, target bigint")
            .groupBy("cell").agg(F.sum("background").alias("background"), F.sum("target").alias("target")))


def log_table(vocab: Vocabulary, cells: np.ndarray, counts: np.ndarray, prior: float = PRIOR) -> np.ndarray:
    """log p(token | context) as a flat table over context * size + token."""
    pairs = np.zeros((vocab.size + 1, vocab.size))
    pairs.ravel()[cells] = counts
    single = (pairs.sum(axis=0) + 1.0) / (pairs.sum() + vocab.size)
    totals = pairs.sum(axis=1, keepdims=True) + prior
    pairs += prior * single
    pairs /= totals
    return np.log(pairs, out=pairs).ravel()


def cross_entropy_difference(documents: DataFrame, target_ids: DataFrame, id_col: str = "doc_id",
                             text_col: str = "text", words: int | None = WORDS, prior: float = PRIOR,
                             chunk: int = CHUNK, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, n_tokens, ce_target, ce_background, score) of every row, in nats a
    token; ``target_ids``: a table whose ``id_col`` names the target documents;
    ``words``: size of the vocabulary, None for all words; ``chunk``, ``bucket``: bytes of
    text counted together and met in one group, without effect on the result."""
    if words is None:
        return _whole_vocabulary(documents, target_ids, id_col, text_col, prior, chunk, bucket)
    docs = id_text(documents, id_col, text_col)
    vocab = vocabulary(docs, words)
    wanted = target_ids.select(F.col(f"`{id_col}`").alias("doc_id")).filter("doc_id is not null").distinct()
    # a shuffle join at every size: the target may hold as many rows as the documents
    flagged = docs.join(wanted.withColumn("target", F.lit(True)).hint("merge"), "doc_id", "left").select(
        "text", F.coalesce("target", F.lit(False)).alias("target"))
    counts = pair_counts(flagged, vocab).toArrow()  # (words + 257) * (words + 256) rows at most
    cells = counts.column("cell").to_numpy()
    tables = [log_table(vocab, cells, counts.column(c).to_numpy(), prior) for c in ("target", "background")]
    shared = docs.sparkSession.sparkContext.broadcast((vocab, *tables))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, target, background = shared.value
        for part, texts in text_chunks(batches):
            at, first = vocab.cells(texts)
            n = np.diff(first)
            sums = []
            for table in (target, background):
                run_up = np.concatenate([[0.0], np.cumsum(table[at])])
                sums.append(-(run_up[first[1:]] - run_up[first[:-1]]) / np.maximum(n, 1))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), pa.array(n.astype(np.int64)), pa.array(sums[0]),
                 pa.array(sums[1]), pa.array(sums[0] - sums[1])],
                names=["doc_id", "n_tokens", "ce_target", "ce_background", "score"])

    return docs.mapInArrow(
        run, "doc_id bigint, n_tokens bigint, ce_target double, ce_background double, score double")


def _pair_keys(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each (context, word), evenly spread over the whole range."""
    with np.errstate(over="ignore"):
        key = context * np.uint64(0x9E3779B97F4A7C15) + (word ^ (word >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        key = (key ^ (key >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return key ^ (key >> np.uint64(32))


def _tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, context, first token of each text): words as hashes, :data:`START`
    as the context of a text's first word."""
    word, first = words_of(texts)
    context = np.concatenate([np.array([START], np.uint64), word[:-1]]) if len(word) else word
    context[first[:-1][first[:-1] < len(word)]] = START
    return word, context, first


def _bucket_ends(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket starts in sorted keys: buckets are equal ranges of hashes."""
    starts = [-(-(b << 64) // buckets) for b in range(1, buckets)]
    return np.concatenate([[0], np.searchsorted(keys, np.array(starts, np.uint64)), [len(keys)]])


#: Texts are compressed at this level of zstd, keys and counts at its fastest one.
LEVEL = 6
_TEXTS = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=LEVEL))
_ZSTD = pa.Codec("zstd", compression_level=1)


def _packed(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=_TEXTS) as out:
        out.write_table(rows.combine_chunks())
    return sink.getvalue().to_pybytes()


def _texts_of(packed: bytes) -> pa.Table:
    return pa.ipc.open_stream(packed).read_all()


def _pack_chunks(chunk: int):
    """mapInArrow function: one row (chunk, size, ids, rows) for each ``chunk`` bytes of a
    task's texts in turn; the rows themselves are one compressed value."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, done, held = TaskContext.get().partitionId() << 32, 0, []

        def flush(number: int) -> pa.RecordBatch:
            rows = pa.Table.from_batches(held)
            size = pc.sum(pc.binary_length(rows.column("text"))).as_py() or 0
            ids = rows.column("doc_id").combine_chunks().cast(pa.int64())
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([base + number]), pa.array([size + len(rows)]),
                 pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), ids), pa.array([_packed(rows)], pa.binary())],
                names=["chunk", "size", "ids", "rows"])

        open_one = 0
        for batch in batches:
            sizes = np.asarray(pc.binary_length(batch.column("text")), dtype=np.int64) + 1
            upto = done + np.cumsum(sizes)
            number = (upto - sizes) // chunk
            cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(number)]
            for at, end in zip(cuts[:-1], cuts[1:]):
                if end > at:
                    if held and number[at] != open_one:
                        yield flush(open_one)
                    open_one = int(number[at])
                    held.append(batch.slice(at, end - at))
            done = int(upto[-1]) if len(upto) else done
        if held:
            yield flush(open_one)
    return pack


def _squeeze(arrays: list[np.ndarray]) -> bytes:
    """Arrays as one compressed value: the bytes of equal rank lie together, so the high
    ones, which are mostly zero, take no room."""
    raw = b"".join(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes() for x in arrays)
    return len(raw).to_bytes(8, "little") + _ZSTD.compress(raw, asbytes=True)


def _spread(value: bytes, sizes: list[int], kind: str) -> list[np.ndarray]:
    """The arrays of :func:`_squeeze`, all of one kind."""
    raw = np.frombuffer(_ZSTD.decompress(value[8:], int.from_bytes(value[:8], "little"), asbytes=True), np.uint8)
    width, out, at = np.dtype(kind).itemsize, [], 0
    for n in sizes:
        out.append(np.ascontiguousarray(raw[at:at + n * width].reshape(width, n).T).view(kind).ravel())
        at += n * width
    return out


_COUNTED = "n_words int, n_pairs int, keys binary, counts binary"
_ANSWER = "n_words int, n_pairs int, sums binary, totals array<bigint>"


def _places(word: np.ndarray, context: np.ndarray):
    """The distinct words and pairs of a chunk, in order, and the place among them of each
    token, of its context and of its pair."""
    known, place = np.unique(np.concatenate([word, context]), return_inverse=True)
    pairs, pair = np.unique(_pair_keys(context, word), return_inverse=True)
    return known, place[:len(word)], place[len(word):], pairs, pair


def _count_chunks(buckets: int):
    """mapInArrow function: chunks (chunk, rows, chosen: places of the rows in the target) to
    their distinct words and pairs with their counts, one row per bucket of hashes."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, packed, chosen in zip(*(batch.column(c) for c in ("chunk", "rows", "chosen"))):
                rows = _texts_of(packed.as_py())
                word, context, first = _tokens(rows.column("text").to_pylist())
                target = np.zeros(len(rows), bool)
                target[np.asarray(chosen.as_py() or [], np.int64)] = True
                del rows
                marked = np.repeat(target, np.diff(first))
                known, own, before, pairs, pair = _places(word, context)
                word_n = [np.bincount(x, minlength=len(known)).astype("<u4") for x in (own, own[marked], before, before[marked])]
                pair_n = [np.bincount(x, minlength=len(pairs)).astype("<u4") for x in (pair, pair[marked])]
                word_at, pair_at = _bucket_ends(known, buckets), _bucket_ends(pairs, buckets)
                full = np.flatnonzero((np.diff(word_at) + np.diff(pair_at)) > 0)
                out = {"n_words": [], "n_pairs": [], "keys": [], "counts": []}
                for b in full:
                    w, p = slice(word_at[b], word_at[b + 1]), slice(pair_at[b], pair_at[b + 1])
                    # sorted keys are sent as the steps between them
                    steps = [np.diff(k, prepend=np.uint64(0)) for k in (known[w], pairs[p])]
                    out["n_words"].append(w.stop - w.start)
                    out["n_pairs"].append(p.stop - p.start)
                    out["keys"].append(_squeeze(steps))
                    out["counts"].append(_squeeze([*[x[w] for x in word_n], *[x[p] for x in pair_n]]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(full), chunk.as_py())), pa.array(full.astype(np.int64)),
                     *[pa.array(out[c], pa.int32()) for c in ("n_words", "n_pairs")],
                     *[pa.array(out[c], pa.binary()) for c in ("keys", "counts")]],
                    names=["chunk", "bucket", "n_words", "n_pairs", "keys", "counts"])
    return count


def _sum_bucket(table: pa.Table) -> pa.Table:
    """A bucket's counts summed over all chunks, and handed to each chunk in the order of
    its distinct keys: of all documents what the other chunks add, of the target the sum.
    The row without a chunk holds the bucket's words and tokens."""
    n_words, n_pairs = table.column("n_words").to_pylist(), table.column("n_pairs").to_pylist()
    sent = [(_spread(k.as_py(), [w, p], "<u8"), _spread(c.as_py(), [w] * 4 + [p] * 2, "<u4"))
            for k, c, w, p in zip(table.column("keys"), table.column("counts"), n_words, n_pairs)]
    answers: list[list[np.ndarray]] = [[] for _ in sent]
    for place, columns in ((0, (0, 1, 2, 3)), (1, (4, 5))):
        steps = [keys[place] for keys, _ in sent]
        ends = np.cumsum([0, *map(len, steps)])
        keys, inverse = np.unique(np.concatenate([np.cumsum(x, dtype=np.uint64) for x in steps]), return_inverse=True)
        for c in columns:
            local = np.concatenate([counts[c] for _, counts in sent]).astype(np.int64)
            sums = np.bincount(inverse, local, len(keys)).astype(np.int64)
            if c == 0:
                totals = [int((sums > 0).sum()), int(sums.sum())]
            elif c == 1:
                totals.append(int(sums.sum()))
            back = sums[inverse] - (local if c % 2 == 0 else 0)
            for mine, at, end in zip(answers, ends[:-1], ends[1:]):
                mine.append(back[at:end].astype("<u8"))
    n = table.num_rows
    return pa.Table.from_arrays(
        [pa.array([*table.column("chunk").to_pylist(), None], pa.int64()),
         pa.array(np.full(n + 1, table.column("bucket")[0].as_py())), pa.array([*n_words, None], pa.int32()),
         pa.array([*n_pairs, None], pa.int32()), pa.array([*map(_squeeze, answers), None], pa.binary()),
         pa.array([None] * n + [totals], pa.list_(pa.int64()))],
        names=["chunk", "bucket", "n_words", "n_pairs", "sums", "totals"])


def _score_chunks(words: int, tokens: dict[str, int], weight: dict[str, float]):
    """Cogroup function: a chunk's rows and its counts to the losses of each row."""
    def score(packed: pa.Table, answers: pa.Table) -> pa.Table:
        rows = _texts_of(packed.column("rows")[0].as_py())
        word, context, first = _tokens(rows.column("text").to_pylist())
        n = np.diff(first)
        means = [np.zeros(len(n))] * 2
        if len(word):
            answers = answers.sort_by("bucket")
            known, own, before, pairs, pair = _places(word, context)
            parts = [_spread(v.as_py(), [w] * 4 + [p] * 2, "<u8") for v, w, p in zip(
                answers.column("sums"), *(answers.column(c).to_pylist() for c in ("n_words", "n_pairs")))]
            sums = [np.concatenate([p[c] for p in parts]).astype(np.int64) for c in range(6)]
            if len(sums[0]) != len(known) or len(sums[4]) != len(pairs):
                raise RuntimeError("the counts of a chunk do not fit its texts")
            for c, at in ((0, own), (2, before), (4, pair)):  # what this chunk itself adds
                sums[c] += np.bincount(at, minlength=len(sums[c]))
            means = []
            for model, (single, after, both) in (("target", sums[1::2]), ("background", sums[::2])):
                prior = weight[model] * ((single[own] + 1.0) / float(tokens[model] + words))
                loss = -np.log((both[pair] + prior) / (after[before] + weight[model]))
                run_up = np.concatenate([[0.0], np.cumsum(loss)])
                means.append((run_up[first[1:]] - run_up[first[:-1]]) / np.maximum(n, 1))
        return pa.Table.from_arrays(
            [rows.column("doc_id").cast(pa.int64()), pa.array(n.astype(np.int64)), pa.array(means[0]),
             pa.array(means[1]), pa.array(means[0] - means[1])],
            names=["doc_id", "n_tokens", "ce_target", "ce_background", "score"])
    return score


def _whole_vocabulary(documents: DataFrame, target_ids: DataFrame, id_col: str, text_col: str,
                      prior: float, chunk: int, bucket: int) -> DataFrame:
    """:func:`cross_entropy_difference` with every word of the documents as a token.

    Texts are stored in chunks of ``chunk`` bytes, one compressed row each. A chunk sends its
    distinct words and pairs, as hashes with counts, to buckets of hashes; a bucket sums them
    over all chunks and sends each chunk the sums in the order of its keys. So a key moves once
    per chunk, however often it occurs there, and sums come back without keys or documents.
    A bucket receives the keys of ``bucket`` bytes of text on average, and a frequent key
    once per chunk. The chunks are counted where they were stored: which rows are in the target
    comes to them as places. They are shuffled once, to meet the sums. The background model is
    matched to the target in size: its counts weigh as if it had as many tokens."""
    docs = id_text(documents, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    # numbered where the rows are first written, so that every later step has the same numbers
    chunks = stored(docs.mapInArrow(
        _pack_chunks(chunk), "chunk bigint, size bigint, ids array<bigint>, rows binary"), "lm-chunks")
    buckets = 1 + (chunks.agg(F.sum("size")).first()[0] or 0) // bucket
    wanted = target_ids.select(F.col(f"`{id_col}`").alias("doc_id")).filter("doc_id is not null").distinct()
    places = chunks.select("chunk", F.posexplode("ids").alias("place", "doc_id")).join(wanted, "doc_id", "left_semi")
    chosen = stored(places.groupBy("chunk").agg(F.collect_list("place").alias("chosen")), "lm-chosen")
    sent = chunks.select("chunk", "rows").join(chosen, "chunk", "left").mapInArrow(
        _count_chunks(buckets), f"chunk bigint, bucket bigint, {_COUNTED}")
    sums = stored(sent.groupBy("bucket").applyInArrow(_sum_bucket, f"chunk bigint, bucket bigint, {_ANSWER}"), "lm-sums")
    facts = sums.filter("chunk is null").agg(
        *[F.coalesce(F.sum(F.col("totals")[k]), F.lit(0)).alias(name)
          for k, name in enumerate(("words", "background", "target"))]).first()
    tokens = {m: facts[m] for m in ("target", "background")}
    weight = {"target": prior,
              "background": prior * tokens["background"] / tokens["target"] if tokens["target"] else prior}
    score = _score_chunks(facts["words"] + 256, tokens, weight)
    answers = sums.filter("chunk is not null").select("chunk", "bucket", "n_words", "n_pairs", "sums")
    return chunks.select("chunk", "rows").groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        score, "doc_id bigint, n_tokens bigint, ce_target double, ce_background double, score double")
