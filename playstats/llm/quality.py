"""Quality classifier with supervised subword embeddings.

A document's features are its words, its word pairs and its character 3- and
4-grams (case kept), hashed into ``BUCKETS`` rows of a learned embedding table;
pairs are hashed so that any word followed by itself is one feature. The document
vector is the mean of its features' vectors; a softmax layer gives the
probability of each label. Table and layer are trained by stochastic gradient
descent in numpy.

Learning uses a bounded sample, ``per_class`` ids of each label at most (those
with the smallest hash of the id; parameter, default 1,500) and one row of each
(that with the smallest hash of the text). So at most ``2 * per_class`` rows of
``BUCKETS`` buckets with 8 bytes each reach the driver: 1.6 GB if every text had
every bucket, about 50 MB for the given documents. The classes are weighted
back to their shares among all learning labels. Scoring covers every whole text:
at score time a feature's vector and the softmax layer collapse to one number
per bucket, so a score is a mean over one table look-up per feature.

Labels, lang, source and doc_id are never inputs of a score.

Edge cases: null or empty text has one feature only, the one every text has,
and so gets the label shares' score. Several label rows of one id: the smallest
label counts. Without learning rows every score is 0.5. Repeated rows and ids
are scored row by row. An empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playstats.llm.common import handed_on, id_text, text_chunks, with_row
from playstats.llm.language_id import remainder
from playstats.llm.textops import mix, words_of

BUCKETS = 1 << 16
DIM = 8
PER_CLASS = 1_500
EPOCHS, RATE = 8, 2.0
ACCEPT = 0.3


def features(texts: list[str]) -> list[np.ndarray]:
    """Buckets of each text: 0 once, then words (first quarter), pairs (second) and
    character grams (upper half)."""
    half, quarter, bits = BUCKETS // 2, BUCKETS // 4, np.uint64(64 - 15)
    words, first = words_of(texts, lower=False)
    word_at = (words % np.uint64(quarter - 1)).astype(np.int64) + 1
    pair_at = ((words[1:] - words[:-1]) % np.uint64(quarter)).astype(np.int64) + quarter
    out = []
    for k, text in enumerate(texts):
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        a, b = first[k], first[k + 1]
        parts = [np.zeros(1, np.int64), word_at[a:b], pair_at[a:max(a, b - 1)]]
        key = points
        for n in range(2, 5):
            if len(points) < n:
                break
            key = key[:-1] * np.uint64(0x9E3779B1) + points[n - 1:]
            if n > 2:
                parts.append((mix(key + np.uint64(n)) >> bits).astype(np.int64) + half)
        out.append(np.concatenate(parts))
    return out


class Classifier:
    """Embedding table, softmax layer, and the collapsed table for scoring."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.table = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
        self.layer = np.zeros((DIM, 2), np.float32)
        self.bias = np.zeros(2, np.float32)

    def fit(self, bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, weights: np.ndarray,
            epochs: int = EPOCHS, rate: float = RATE, seed: int = 7) -> Classifier:
        """``bags``: distinct buckets of each document and their shares of its features."""
        rng, steps, done = np.random.default_rng(seed), max(1, epochs * len(bags)), 0
        for _ in range(epochs):
            for k in rng.permutation(len(bags)):
                at, share = bags[k]
                lr, done = rate * (1 - done / steps), done + 1
                vector = share @ self.table[at]
                logits = vector @ self.layer + self.bias
                p = np.exp(logits - logits.max())
                error = p / p.sum()
                error[labels[k]] -= 1.0
                error *= weights[k]
                back = self.layer @ error
                self.layer -= lr * np.outer(vector, error)
                self.bias -= 0.1 * lr * error
                self.table[at] -= (lr * share)[:, None] * back[None, :]
        return self

    def collapsed(self) -> tuple[np.ndarray, float]:
        """(one number per bucket, offset): a document's log odds are their mean plus the offset."""
        return (self.table @ (self.layer[:, 1] - self.layer[:, 0])).astype(np.float64), float(
            self.bias[1] - self.bias[0])


def learn(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", per_class: int = PER_CLASS) -> tuple[np.ndarray, float]:
    """The collapsed classifier for ``label_col`` in (0, 1), learned from the labelled
    rows whose id's crc32 modulo 5 is not 0."""
    named = (labels.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{label_col}`").alias("label"))
             .filter(F.col("label").isin(0, 1) & (remainder("doc_id", 5) != 0))
             .groupBy("doc_id").agg(F.min("label").alias("label")))
    shares = {r["label"]: r["count"] for r in named.groupBy("label").count().collect()}
    ids = None
    for label in (0, 1):
        least = (named.filter(F.col("label") == label)
                 .orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class))
        ids = least if ids is None else ids.unionAll(least)
    # 2 * per_class ids and labels: a proven bound; a repeated id counts as one row
    sample = (id_text(documents, id_col, text_col).join(F.broadcast(ids), "doc_id")
              .groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least"))
              .select("doc_id", "least.text", "label"))

    def bag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_chunks(batches):
            pairs = [np.unique(f, return_counts=True) for f in features(texts)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), part.column("label").cast(pa.int32()),
                 pa.array([a.astype("<i4").tobytes() for a, _ in pairs], pa.binary()),
                 pa.array([n.astype("<f4").tobytes() for _, n in pairs], pa.binary())],
                names=["doc_id", "label", "at", "n"])

    got = sample.mapInArrow(bag, "doc_id bigint, label int, at binary, n binary").toArrow()
    rows = sorted(zip(got.column("doc_id").to_pylist(), got.column("label").to_pylist(),
                      got.column("at").to_pylist(), got.column("n").to_pylist()))
    y = np.array([r[1] for r in rows], np.int64)
    bags = []
    for _, _, at, n in rows:
        counts = np.frombuffer(n, "<f4")
        bags.append((np.frombuffer(at, "<i4"), counts / counts.sum()))
    drawn, total = np.bincount(y, minlength=2), max(1, sum(shares.values()))
    weight = [len(y) * shares.get(c, 0) / total / max(1, drawn[c]) for c in (0, 1)]
    return Classifier().fit(bags, y, np.array([weight[c] for c in y], np.float32)).collapsed()


def score(documents: DataFrame, model: tuple[np.ndarray, float], id_col: str = "doc_id",
          text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """(doc_id, score) of every whole text. ``row_col``: a column that is handed on
    as ``row``."""
    docs = id_text(documents, id_col, text_col, *handed_on(row_col))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, offset = shared.value
        for part, texts in text_chunks(batches):
            odds = np.array([table[f].mean() for f in features(texts)]) + offset
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), pa.array(1.0 / (1.0 + np.exp(-np.clip(odds, -500, 500)))),
                 *part.columns[2:]],
                names=["doc_id", "score", *part.schema.names[2:]])

    return docs.mapInArrow(run, with_row("doc_id bigint, score double", docs))


def quality_scores(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "quality", per_class: int = PER_CLASS, accept: float = ACCEPT,
                   row_col: str | None = None) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row. ``row_col``: a column that
    is handed on as ``row``."""
    model = learn(documents, labels, id_col, text_col, label_col, per_class)
    return score(documents, model, id_col, text_col, row_col).select(
        "doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score",
        (F.col("score") >= accept).cast("int").alias("predicted"), *([] if row_col is None else ["row"]))
