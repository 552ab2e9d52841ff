"""Vectorised word handling over UTF-8 bytes.

Words, lower-casing of A-Z and their hashes are worked out for a whole group of
texts at once in numpy. The 64-bit hashes are fixed functions of the bytes, so
every task and every run gets the same values.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

_C1 = np.uint64(0x9E3779B97F4A7C15)
_C2 = np.uint64(0xC2B2AE3D27D4EB4F)
_R32, _R29 = np.uint64(32), np.uint64(29)

#: Bytes that end a word of white-space text: space and 0x09-0x0D.
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    h = h * _C1
    h ^= h >> _R32
    h = h * _C2
    h ^= h >> _R29
    return h


def span_hash(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span; ``data`` must end with 8 bytes more."""
    eight = np.ndarray(shape=(max(len(data) - 7, 0),), dtype="<u8", buffer=data, strides=(1,))
    h = mix(sizes.astype(np.uint64) + _C2)
    live, at, rest = np.arange(len(starts)), starts.astype(np.int64), sizes.astype(np.int64)
    while len(live):
        load = eight[at]
        short = rest < 8
        load[short] &= (np.uint64(1) << (rest[short].astype(np.uint64) * np.uint64(8))) - np.uint64(1)
        h[live] = mix(h[live] ^ load)
        go = rest > 8
        live, at, rest = live[go], at[go] + 8, rest[go] - 8
    return h


def word_spans(texts: Sequence[str], breaks: np.ndarray = WHITE, lower: bool = True):
    """(bytes of all texts, start and end of every word, first word of each text).
    Text k's words are numbers ``first[k]`` to ``first[k + 1]``."""
    blobs = [t.encode("utf-8") for t in texts]
    data = np.frombuffer(b" ".join(blobs) + b" " * 9, np.uint8)
    if lower:
        data = _LOWER[data]
    inside = ~breaks[data]
    inside[-9:] = False
    edge = np.diff(np.concatenate([[False], inside]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    begins = np.concatenate([[0], np.cumsum([len(b) + 1 for b in blobs])]) if blobs else np.zeros(1, np.int64)
    return data, starts, ends, np.searchsorted(starts, begins)


def words_of(texts: Sequence[str], breaks: np.ndarray = WHITE, lower: bool = True):
    """(hash of every word, first word of each text)."""
    data, starts, ends, first = word_spans(texts, breaks, lower)
    return span_hash(data, starts, ends - starts), first


_PLACES = mix(np.arange(1, 65, dtype=np.uint64))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` consecutive words; of all of them if fewer; none if none."""
    if len(words) == 0:
        return words
    n_here = min(n, len(words))
    total = np.full(len(words) - n_here + 1, np.uint64(n_here))
    for k in range(n_here):
        total += words[k:len(words) - n_here + 1 + k] * (_PLACES[k] | np.uint64(1))
    return mix(total)
