"""Small tables and brute-force versions used by the tests."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def docs(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, SCHEMA)


def rows_by_id(df):
    return {r["doc_id"]: r.asDict() for r in df.collect()}


def sentence(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def shingles(text: str | None, size: int = 5) -> frozenset:
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if len(words) < size:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1))


def brute_components(sets: dict) -> dict:
    """id -> smallest id reachable over pairs with 100 * intersection >= 75 * union."""
    ids = sorted(sets)
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders: dict = {}
    for i in ids:
        for s in sets[i]:
            holders.setdefault(s, []).append(i)
    for i in ids:
        counts: dict = {}
        for s in sets[i]:
            for j in holders[s]:
                if j < i:
                    counts[j] = counts.get(j, 0) + 1
        for j, both in counts.items():
            if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}
