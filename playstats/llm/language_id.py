"""Language identification by mixtures of languages.

*Learning*: hashed counts of 1- to 3-character grams per language, summed over
all learning documents (per task first, then by a Spark aggregate). A model is a
table of log likelihoods, ``BUCKETS`` x languages, of fixed size per language.

*Prediction*: a document is a mixture of languages, each word being of one of
them; a word's likelihood in a language is the product over its grams.
Expectation-maximisation estimates the document's language proportions. The
language set is chosen by penalised likelihood: languages enter in the order of
their proportion as long as each gains more log likelihood than
``PENALTY * log(words) + SHARE_COST * words``. ``lang_pred`` is the language with
the largest proportion and ``score`` that proportion.

``fit`` tells a text in one of the languages from one in none of them: the log
likelihood per gram of the chosen mixture, placed between what the model gives
random grams (0) and what it gives the language's own learning texts (1). Below
:data:`LEAST_FIT` a text is nearer to noise than to any learned language.

Grams are taken from lower-cased letters and marks, all other characters being
word breaks. Neither lang, source nor doc_id enter a prediction.

Edge cases: null, empty or letterless text: ``und`` with score and fit 0.0. Rows without
lang are not learned from. Without any learning row every prediction is
``und``. Repeated rows and ids are handled row by row. An empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playstats.llm.common import handed_on, text_chunks, with_row
from playstats.llm.textops import mix

BUCKETS = 1 << 15
ORDERS = 3
SMOOTH = 0.5
PENALTY, SHARE_COST = 2.0, 0.1
ROUNDS, CLOSE = 30, 1e-4
UNKNOWN = "und"
LEAST_FIT = 0.5
#: Distinct values of ``lang``: what is learned takes 512 * 32,768 * 8 bytes at most.
MOST_LANGUAGES = 512
_PLACES = mix(np.arange(1, ORDERS + 1, dtype=np.uint64)) | np.uint64(1)


@functools.cache
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For every code point: is it a letter; is it a letter or a mark."""
    kinds = [unicodedata.category(chr(c))[0] for c in range(sys.maxunicode + 1)]
    letter = np.array([k == "L" for k in kinds])
    return letter, letter | np.array([k == "M" for k in kinds])


def grams(text: str) -> tuple[np.ndarray, np.ndarray] | None:
    """(buckets [positions, ORDERS], first position of each word); None without a
    letter. A position is a character of a word or the break after it."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    letter, inside = _letters()
    if not letter[points].any():
        return None
    symbols = np.where(inside[points], points, 32).astype(np.uint64)
    symbols = np.concatenate([[np.uint64(32)], symbols, [np.uint64(32)]])
    blank = symbols == 32
    symbols = symbols[~(blank & np.concatenate([[False], blank[:-1]]))]
    key, table = np.zeros(len(symbols) - 1, np.uint64), []
    for back in range(ORDERS):  # the gram of back+1 symbols that ends at each position but the first
        shifted = symbols[max(1 - back, 0):len(symbols) - back]
        pad = len(key) - len(shifted)
        if pad > 0:
            shifted = np.concatenate([np.full(pad, 32, np.uint64), shifted])
        key = key + shifted * _PLACES[back]
        table.append(mix(key + np.uint64(back)) >> np.uint64(64 - 15))
    words = np.flatnonzero(symbols[:-1] == 32)  # position after each break
    return np.stack(table, axis=1).astype(np.int64), words


def remainder(id_col: str, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary")) % of


class Model:
    """Languages and their log likelihoods of each bucket."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        totals = counts.sum(axis=0, keepdims=True)
        self.log = np.log((counts + SMOOTH) / (totals + SMOOTH * BUCKETS)).astype(np.float32)
        # mean log likelihood of a gram drawn at random, and of one of the learning texts
        self.noise = self.log.mean(axis=0, dtype=np.float64)
        self.own = (counts * self.log).sum(axis=0) / np.maximum(totals[0], 1)

    def word_likelihoods(self, found: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """One row for each word, one column for each language."""
        buckets, words = found
        each = self.log[buckets[:, 0]]
        for k in range(1, ORDERS):
            each = each + self.log[buckets[:, k]]
        return np.add.reduceat(each, words, axis=0, dtype=np.float64)

    def predict(self, text: str) -> tuple[str, float, list[tuple[str, float]], float]:
        """(language, its proportion, all chosen languages with proportions, fit)."""
        found = grams(text) if self.languages else None
        if found is None:
            return UNKNOWN, 0.0, [], 0.0
        logs = self.word_likelihoods(found)
        shares, _ = mixture(logs)
        order = np.argsort(-shares, kind="stable")
        first = int(np.argmax(logs.sum(axis=0)))
        chosen, best = [first], logs[:, first].sum()
        shares = np.ones(1)
        cost = PENALTY * np.log(len(logs) + 1) + SHARE_COST * len(logs)
        for language in order:
            if language in chosen:
                continue
            trial = [*chosen, int(language)]
            new, gained = mixture(logs[:, trial])
            if gained - best <= cost:
                break
            chosen, best, shares = trial, gained, new
        ranked = sorted(zip(shares.tolist(), chosen), key=lambda x: (-x[0], x[1]))
        out = [(self.languages[k], s) for s, k in ranked]
        noise, own = (sum(s * table[k] for s, k in ranked) for table in (self.noise, self.own))
        fit = (best / found[0].size - noise) / max(own - noise, 1e-9)
        return out[0][0], min(1.0, out[0][1]), out, float(fit)


def mixture(logs: np.ndarray) -> tuple[np.ndarray, float]:
    """Proportions of the columns that maximise the likelihood of the rows, by
    expectation-maximisation, and that log likelihood."""
    top = logs.max(axis=1, keepdims=True)
    like = np.exp(logs - top)
    shares = np.full(logs.shape[1], 1.0 / logs.shape[1])
    for _ in range(ROUNDS):
        joint = like * shares
        new = (joint / joint.sum(axis=1, keepdims=True)).mean(axis=0)
        moved = np.abs(new - shares).max()
        shares = new
        if moved < CLOSE:
            break
    return shares, float((np.log(like @ shares) + top[:, 0]).sum())


def learn(documents: DataFrame, text_col: str = "text", lang_col: str = "lang", most: int = MOST_LANGUAGES) -> Model:
    """A model of every language in ``lang_col``, from all rows given. More than
    ``most`` distinct values are an error: a model has ``BUCKETS`` numbers for each, and
    a column with so many holds something else than languages."""
    rows = documents.select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang")).filter(
        "text is not null and lang is not null")
    if len(found := rows.select("lang").distinct().limit(most + 1).collect()) > most:
        raise ValueError(f"more than {most} languages, such as {sorted(r.lang for r in found)[:5]}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[str, np.ndarray] = {}
        for part, texts in text_chunks(batches):
            for text, lang in zip(texts, part.column("lang").to_pylist()):
                if (found := grams(text)) is not None:
                    table = tables.setdefault(lang, np.zeros(BUCKETS, np.int64))
                    table += np.bincount(found[0].ravel(), minlength=BUCKETS)
        for lang, table in tables.items():
            at = np.flatnonzero(table)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(table[at])],
                names=["lang", "bucket", "n"])

    summed = (rows.mapInArrow(count, "lang string, bucket int, n bigint")
              .groupBy("lang", "bucket").agg(F.sum("n").alias("n"))).toArrow()  # BUCKETS rows a language at most
    languages = sorted(set(summed.column("lang").to_pylist()))
    counts = np.zeros((BUCKETS, max(len(languages), 1)))
    place = {lang: k for k, lang in enumerate(languages)}
    column = np.array([place[x] for x in summed.column("lang").to_pylist()], np.int64)
    counts[summed.column("bucket").to_numpy(), column] = summed.column("n").to_numpy()
    return Model(languages, counts)


def predict(documents: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
            row_col: str | None = None) -> DataFrame:
    """(doc_id, lang_pred, score, mixture, fit) of every row; ``mixture``: the chosen
    languages with their proportions, the largest first. ``row_col``: a column
    that is handed on as ``row``."""
    docs = documents.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"),
                            *handed_on(row_col))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_chunks(batches):
            got = [shared.value.predict(t) for t in texts]  # (language, proportion, mixture, fit)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), pa.array([g[0] for g in got], pa.string()),
                 pa.array([g[1] for g in got], pa.float64()),
                 pa.array([[{"lang": a, "share": b} for a, b in g[2]] for g in got],
                          pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))),
                 pa.array([g[3] for g in got], pa.float64()), *part.columns[2:]],
                names=["doc_id", "lang_pred", "score", "mixture", "fit", *part.schema.names[2:]])

    return docs.mapInArrow(run, with_row(
        "doc_id bigint, lang_pred string, score double, mixture array<struct<lang:string,share:double>>, fit double", docs))


def held_out_predictions(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         lang_col: str = "lang", row_col: str | None = None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, fit): learned from the rows whose id's crc32
    modulo 4 is not 2, predicted for all rows; ``held_out``: the remainder is 2.
    ``row_col``: a column that is handed on as ``row``."""
    model = learn(documents.filter(remainder(id_col, 4) != 2), text_col, lang_col)
    return predict(documents, model, id_col, text_col, row_col).select(
        "doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "fit",
        *([] if row_col is None else ["row"]))
