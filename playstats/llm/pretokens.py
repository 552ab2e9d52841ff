"""Pre-tokens of a byte-level BPE vocabulary, and bounded caches of them.

``tokenizers`` cuts a text at its added special strings, splits the rest by one
pattern into pre-tokens and merges bytes inside each pre-token alone. So a
text's ids are the concatenation of its pre-tokens' ids, and every distinct
pre-token need be encoded only once per Python worker.

The split below runs the tokenizer's own pattern with ``regex`` (with ``re``, and
the properties written out, for texts below U+0250). The engines agree on every
assigned code point; on code points that Python's Unicode tables do not know yet
they may differ, so a text holding one is given to the library whole.
"""

from __future__ import annotations

import functools
import json
import re
import struct
import unicodedata

import regex
import tiktoken
from tokenizers import Tokenizer

#: The split pattern of byte-level BPE (fixed value; equals ``public_tokenizers.PATTERN``).
BYTE_LEVEL_PATTERN = (r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")

#: Entries of one generation of a worker's cache.
CACHE_ENTRIES = 250_000


#: Every code point below U+0250 is assigned.
_beyond_latin = re.compile("[^\x00-\u024f]").search


def has_unassigned(text: str) -> bool:
    """Does the text hold a code point that Python's Unicode tables leave unassigned?"""
    return _beyond_latin(text) is not None and any(unicodedata.category(c) == "Cn" for c in set(text))


@functools.cache
def _latin_class(kind: str) -> str:
    """The code points below U+0250 of a Unicode property, as the inside of a class."""
    found = [c for c in range(0x250) if regex.match(kind, chr(c))]
    return "".join(f"\\u{c:04x}" for c in found)


def latin_pattern(pattern: str) -> re.Pattern:
    """The split pattern for texts below U+0250, for the faster ``re`` module."""
    letters, numbers, white = (_latin_class(k) for k in (r"\p{L}", r"\p{N}", r"\s"))
    for name, own in ((r"[^\s\p{L}\p{N}]", f"[^{white}{letters}{numbers}]"), (r"[\p{L}]", f"[{letters}]"),
                      (r"[\p{N}]", f"[{numbers}]"), (r"\p{L}", f"[{letters}]"), (r"\p{N}", f"[{numbers}]"),
                      (r"(?!\S)", f"(?![^{white}])"), (r"\s", f"[{white}]")):
        pattern = pattern.replace(name, own)
    return re.compile(pattern)


def splitter(pattern: str):
    """text -> list of pre-tokens."""
    any_text, latin = regex.compile(pattern).findall, latin_pattern(pattern).findall
    return lambda text: any_text(text) if _beyond_latin(text) else latin(text)


@functools.cache
def byte_symbols() -> dict[int, str]:
    """Byte (as a Latin-1 code point) -> its symbol in byte-level vocabularies:
    printable bytes stand for themselves, the others for U+0100 onwards."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def as_symbols(piece: str) -> str:
    """A pre-token in the byte-level alphabet."""
    if piece.isascii():
        if piece.isalnum():
            return piece
        if piece[:1] == " " and piece[1:].isalnum():
            return "\u0120" + piece[1:]
    return piece.encode("utf-8").decode("latin-1").translate(byte_symbols())


class ByteBpe:
    """The vocabulary file of a byte-level BPE, split into pre-tokens."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.special = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        self._split = splitter(BYTE_LEVEL_PATTERN)
        self._cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None

    def pieces(self, text: str) -> list[str] | None:
        """The text's pre-tokens and special strings in order; None: ask the library."""
        if has_unassigned(text):
            return None
        if self._cut is not None and any(s in text for s in self.special):
            out: list[str] = []
            for part in self._cut.split(text):
                if part in self.special:
                    out.append(part)
                elif part:
                    out += self._split(part)
            return out
        return self._split(text)

    def piece_ids(self, piece: str) -> list[int]:
        """The ids of one pre-token or special string."""
        if piece in self.special:
            return [self.special[piece]]
        return [t.id for t in self.model.tokenize(as_symbols(piece))]

    def piece_bytes(self, piece: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        return id_bytes(self.piece_ids(piece))

    def library_ids(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids


def rank_encoder(bpe: ByteBpe) -> tiktoken.Encoding | None:
    """The vocabulary for ``tiktoken``, which encodes a single pre-token in half the
    time. It merges the pair with the smallest id first, so it fits where the ids are in
    the order of the merges (single bytes, then one id for each merge); None elsewhere."""
    model = json.loads(bpe.library.to_str())["model"]
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    vocab = model["vocab"]
    if len(vocab) < 256 + len(pairs) or any(vocab.get(a + b) != 256 + i for i, (a, b) in enumerate(pairs)):
        return None
    back = {s: bytes([b]) for b, s in byte_symbols().items()}
    ranks = {b"".join(back[c] for c in token): i for token, i in vocab.items() if i < 256 + len(pairs)}
    if len(ranks) != 256 + len(pairs):
        return None
    return tiktoken.Encoding("ranks", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})


def id_bytes(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


@functools.lru_cache(maxsize=2)
def byte_bpe(path: str) -> ByteBpe:
    """One loaded vocabulary per worker and path."""
    bpe = ByteBpe(path)
    bpe.library.no_truncation()
    bpe.library.no_padding()
    return bpe


class PieceCache(dict):
    """pre-token -> value. ``pinned`` entries stay. The others live in two
    generations: when there are more than ``limit`` young ones they become the old
    generation, the previous old one is dropped, and pieces still in use come back
    on their next look-up. So frequent pieces are never worked out again."""

    def __init__(self, work=None, pinned: dict | None = None, limit: int = CACHE_ENTRIES):
        super().__init__(pinned or {})
        self.pinned, self.work, self.limit, self.old = dict(pinned or {}), work, limit, {}

    def __missing__(self, piece: str):
        value = self.old.get(piece)
        if value is None:
            value = self.work(piece)
        self[piece] = value
        return value

    def unknown(self, pieces) -> list[str]:
        """Those of the pieces that no generation has."""
        return [p for p in pieces if p not in self and p not in self.old]

    def trim(self) -> None:
        if len(self) > self.limit + len(self.pinned):
            self.old = dict(self)
            self.clear()
            self.update(self.pinned)
