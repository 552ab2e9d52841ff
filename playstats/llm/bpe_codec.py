"""BPE encoding and decoding by speculation and verification.

A sequence of tokens is the BPE encoding of a word exactly when every adjacent
pair of tokens is the encoding of its own concatenation (and every token is the
encoding of itself). So for each distinct word:

1. *speculate*: greedy longest match over the tokens that encode to themselves;
2. *verify*: all adjacent pairs of all new words are tested at once in numpy.
   A pair fails when, undoing the merges of its two tokens from the last one
   back, some merge across the border has a rank that would have come first;
3. only words with a failing pair are merged exactly, by the library's model.

Words are found as the tokenizer finds them: special strings are cut out of the
raw text, then NFC, lower case, and the split pattern, which drops white space.
Texts with code points newer than Python's Unicode tables go to the library
whole. Every distinct word is worked out once per worker (bounded cache).

Edge cases: a null or empty text has no tokens (checksums of the empty string);
a repeated row or a repeated or null id gives one output row per input row; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from playstats.llm.common import id_text, text_chunks
from playstats.llm.pretokens import PieceCache, as_symbols, has_unassigned, id_bytes, splitter

#: The split pattern of the vocabulary's pre-tokenizer (fixed value).
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
END = "</w>"
NO_RANK = np.int64(1 << 40)


class MergeTable:
    """Merges as arrays: rank of a pair, and the two parts of every token."""

    def __init__(self, vocab: dict[str, int], merges: Sequence[Sequence[str]]):
        self.size = max(vocab.values()) + 1
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        times = np.bincount(made, minlength=self.size)
        self.left = np.full(self.size, -1, np.int64)
        self.right = np.full(self.size, -1, np.int64)
        self.formed = np.full(self.size, -1, np.int64)  # -1: a single symbol
        self.left[made], self.right[made], self.formed[made] = left, right, np.arange(len(made))
        self.whole = self._self_encoding(made, times)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of merging a with b; NO_RANK where there is no such merge."""
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_RANK)

    def compatible(self, a: np.ndarray, b: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """For each pair: no merge across the border comes before both tokens are
        complete (nor, with ``before``, earlier than that rank)."""
        a, b = a.astype(np.int64), b.astype(np.int64)
        good = np.ones(len(a), bool)
        live = np.arange(len(a))
        # ranks below ``limit`` would have been applied while x and y stood side by side
        limit = np.full(len(a), NO_RANK) if before is None else before.astype(np.int64)
        x, y = a.copy(), b.copy()
        while len(live):
            bad = self.rank(x, y) < limit
            good[live[bad]] = False
            fx, fy = self.formed[x], self.formed[y]
            go = ~bad & ((fx >= 0) | (fy >= 0))
            live, x, y, fx, fy = live[go], x[go], y[go], fx[go], fy[go]
            undo_x = fx > fy  # the later merge is undone first; of two equal ones, the right one
            # an equal merge one place to the left is applied first, hence + 1 when the right is undone
            limit = np.where(undo_x, fx, fy + 1)
            x, y = np.where(undo_x, self.right[x], x), np.where(undo_x, y, self.left[y])
        return good

    def _self_encoding(self, made: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Tokens that are the encoding of their own string: their parts are, made
        by one merge only, and nothing comes earlier across the parts' border."""
        ok = np.ones(self.size, bool)
        ok[made] = times[made] == 1
        joins = np.zeros(self.size, bool)
        joins[made] = self.compatible(self.left[made], self.right[made], before=self.formed[made])
        for token in made[np.argsort(self.formed[made], kind="stable")]:  # parts come before the whole
            ok[token] &= joins[token] and ok[self.left[token]] and ok[self.right[token]]
        return ok


class WordBpe:
    """The word-end BPE of one vocabulary file."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        self.vocab: dict[str, int] = model["vocab"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.table = MergeTable(self.vocab, merges)
        self.special = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        self.names = {i: s for s, i in self.vocab.items()} | {i: s for s, i in self.special.items()}
        whole = self.table.whole
        self.inner = {s: i for s, i in self.vocab.items() if whole[i] and not s.endswith(END)}
        self.final = {s[:-len(END)]: i for s, i in self.vocab.items() if whole[i] and s.endswith(END)}
        # longest token that starts with a character pair; none is longer than that
        self.reach: dict[str, int] = {}
        for s in [*self.inner, *self.final]:
            self.reach[s[:2]] = max(self.reach.get(s[:2], 0), len(s))
        self.exact_words = 0
        self._split = splitter(WORD_PATTERN)
        self._cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self._beyond = re.compile("[\u0130\u0300-\U0010ffff]").search

    def _normal(self, text: str) -> str:
        # below U+0300 (but for U+0130) NFC changes nothing and lower() is the library's mapping
        return self.library.normalizer.normalize_str(text) if self._beyond(text) else text.lower()

    def words(self, text: str) -> list[str] | None:
        """The text's words and special strings in order; None: ask the library."""
        if has_unassigned(text):
            return None
        if self._cut is None or not any(s in text for s in self.special):
            return self._split(self._normal(text))
        out: list[str] = []
        for part in self._cut.split(text):
            if part in self.special:
                out.append(part)
            elif part:
                out += self._split(self._normal(part))
        return out

    def propose(self, symbols: str) -> list[int] | None:
        """Greedy longest match over a word in the byte-level alphabet."""
        ids, at, n = [], 0, len(symbols)
        while at < n:
            rest = n - at
            reach = max(1, self.reach.get(symbols[at:at + 2], 1))
            if rest <= reach and (t := self.final.get(symbols[at:])) is not None:
                ids.append(t)
                return ids
            for size in range(min(reach, rest - 1), 0, -1):
                if (t := self.inner.get(symbols[at:at + size])) is not None:
                    ids.append(t)
                    at += size
                    break
            else:
                return None
        return ids

    def encode_words(self, words: Sequence[str]) -> list[list[int]]:
        """The ids of each distinct word."""
        symbols = [as_symbols(w) for w in words]
        guesses = [self.propose(s) for s in symbols]
        sizes = np.array([len(g) if g else 0 for g in guesses], np.int64)
        flat = np.array([t for g in guesses if g for t in g], np.int64)
        word_of = np.repeat(np.arange(len(words)), sizes)
        wrong = sizes == 0
        if len(flat) > 1:
            inside = word_of[:-1] == word_of[1:]
            good = self.table.compatible(flat[:-1][inside], flat[1:][inside])
            wrong[word_of[:-1][inside][~good]] = True
        for k in np.flatnonzero(wrong):
            self.exact_words += 1
            guesses[k] = [t.id for t in self.library.model.tokenize(symbols[k])]
        return guesses

    def decode(self, ids: Sequence[int]) -> str:
        """As the library decodes without a decoder: token strings joined by spaces."""
        names = self.names
        return " ".join([names[i] for i in ids])


@functools.lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBpe:
    return WordBpe(path)


_CACHES: dict[str, PieceCache] = {}


def _cache(path: str) -> PieceCache:
    if path not in _CACHES:
        special = {s: id_bytes([i]) for s, i in word_bpe(path).special.items()}
        _CACHES[path] = PieceCache(pinned=special)
    return _CACHES[path]


def encode_texts(texts: Sequence[str], path: str) -> list[np.ndarray]:
    """The ids of each whole text, as little-endian unsigned 32-bit arrays."""
    bpe, cache = word_bpe(path), _cache(path)
    cut = [bpe.words(t) for t in texts]
    new = cache.unknown(dict.fromkeys(w for words in cut if words for w in words))
    for word, ids in zip(new, bpe.encode_words(new)):
        cache[word] = id_bytes(ids)
    out = []
    for text, words in zip(texts, cut):
        if words is None:
            out.append(np.asarray(bpe.library.encode(text, add_special_tokens=False).ids, "<u4"))
        else:
            out.append(np.frombuffer(b"".join([cache[w] for w in words]), "<u4"))
    cache.trim()
    return out


def encode_decode(documents: DataFrame, vocabulary: str, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>, decoded string) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(vocabulary)
        for part, texts in text_chunks(batches):
            ids = encode_texts(texts, vocabulary)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()),
                 pa.array([a.astype(np.int32) for a in ids], pa.list_(pa.int32())),
                 pa.array([bpe.decode(a.tolist()) for a in ids], pa.string())],
                names=["doc_id", "ids", "decoded"])

    return id_text(documents, id_col, text_col).mapInArrow(
        run, "doc_id bigint, ids array<int>, decoded string")


def codec_digest(documents: DataFrame, vocabulary: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): the digests of
    :func:`encode_decode`, taken in the same task so that neither ids nor decoded
    texts leave the Python worker."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(vocabulary)
        for part, texts in text_chunks(batches):
            ids = encode_texts(texts, vocabulary)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), pa.array([len(a) for a in ids], pa.int64()),
                 pa.array([hashlib.sha256(a.tobytes()).hexdigest() for a in ids], pa.string()),
                 pa.array([hashlib.sha256(bpe.decode(a.tolist()).encode("utf-8")).hexdigest() for a in ids],
                          pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return id_text(documents, id_col, text_col).mapInArrow(
        run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
