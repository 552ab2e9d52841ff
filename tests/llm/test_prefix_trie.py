"""The burst trie against a dictionary of prefixes."""

import hashlib
import random
import re
import zlib

import pytest

from playstats.llm import prefix_trie as pt

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth string, h1 int"


def brute(rows):
    convs: dict = {}
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            d = hashlib.md5(f"{len(r.encode())}:{r}{x}".encode()).digest()
            convs.setdefault(c, []).append((t is not None, t or 0, d, r, x))
    convs = {c: [(r, x) for *_, r, x in sorted(v)] for c, v in convs.items()}
    members: dict = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        new = tuple(convs.get(c - c % 20, [])[:h] + own[h:])
        for d in range(len(new) + 1):
            members.setdefault(new[:d], ([], []))[0].append(c)
        members[new][1].append(c)
    children: dict = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        leaves[p] = sum(leaves[q] for q in children.get(p, [])) or 1
        saved[p] = sum(saved[q] for q in children.get(p, [])) + (len(members[p][0]) - 1) * words
    return sorted((min(m), len(p), min(members[p[:-1]][0]) if p else None, len(m), len(children.get(p, [])), leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(e))).encode()).hexdigest()) for p, (m, e) in members.items())


def got(spark, rows, limit):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)
    return sorted(tuple(r)[:8] for r in pt.prefix_trie(df, limit).collect())


def dialogues(seed):
    rng = random.Random(seed)
    rows = []
    for c in [*range(60), -3, -40, 10_000]:
        for t in range(rng.randrange(1, 7)):
            rows.append((c, t, rng.choice(["user", "system", None]), rng.choice(["hi", "a b", None, "", f"own {rng.random()}"])))
    rows += [(c, t, "user", f"shared {t}") for c in range(100, 130) for t in range(6)]                # copies
    rows += [(c, t, "user", f"long {t}" if t < 90 else f"{c} {t}") for c in range(200, 206) for t in range(95)]
    rows += [(300, t, "user", f"alone {t}") for t in range(200)]                                     # one long conversation
    rows += [(400, None, "user", "x"), (400, None, "user", "x"), (400, 3, "a", "b"), (400, 3, "a", "c")]  # ties and repeats
    rows += [(None, 1, "user", "nobody")] * 3
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("limit", [1, 10, 150, 4096])
def test_equals_all_prefixes(spark, limit):
    rows = dialogues(limit)
    assert got(spark, rows, limit) == brute(rows)


def test_most_rows_in_one_conversation_and_repeated(spark):
    rows = [(20, 5, "user", "again")] * 500 + [(c, 0, "user", "first") for c in range(19, 25)]
    assert got(spark, rows, 50) == brute(rows)


def test_empty_table_and_texts_of_nodes(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert pt.prefix_trie(empty).collect() == []
    df = spark.createDataFrame([(20, 0, "user", "a long text " * 20_000, "x", 1), (20, 1, None, None, "x", 1)], SCHEMA)
    back = pt.node_turns(pt.prefix_trie(df), df).orderBy("depth").collect()
    assert [(r.depth, r.role, r.text) for r in back] == [(0, None, None), (1, "user", "a long text " * 20_000), (2, "", "")]


def test_running_in_small_blocks(spark):
    rng = random.Random(5)
    rows = [(k % 3, k // 3, rng.randrange(1 << 40)) for k in range(120)]
    df = spark.createDataFrame(rows, "key bigint, place bigint, v bigint")
    out = pt.running(df, "key", "place", {"s": ("v", "sum"), "x": ("v", "xor")}, block=4).collect()
    for r in out:
        before = [v for k, p, v in rows if k == r.key and p < r.place]
        x = 0
        for v in before:
            x ^= v
        assert (r.s, r.x) == (sum(before), x)
