import random

import numpy as np
import pytest

from playstats.llm import minhash_dedup as m
from tests.llm.helpers import brute_components, docs, rows_by_id, sentence, shingles


def _corpus():
    rng = random.Random(5)
    texts = [sentence(rng, rng.choice([3, 6, 20, 80, 300])) for _ in range(60)]
    base = sentence(rng, 120)
    for _ in range(40):  # near copies that need not be near each other
        words = base.split()
        for _ in range(rng.choice([0, 1, 2, 3])):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    texts += [texts[3]] * 10 + [base.upper()] * 3
    passage = sentence(rng, 60)
    texts += [sentence(rng, 40) + " " + passage for _ in range(30)]  # share a passage, not near
    chain = sentence(rng, 60).split()
    for k in range(12):  # each near the one before only
        chain = chain[:-4] + [f"c{k}{i}" for i in range(4)] if k % 2 else [f"d{k}{i}" for i in range(4)] + chain[4:]
        texts.append(" ".join(chain))
    texts += ["", None, "  \t\n", "one", "ONE", "one two", "a b c d e", "a b c d e f", "é É"]
    return texts


def test_equals_brute_force(spark):
    texts = _corpus()
    got = rows_by_id(m.near_duplicates(docs(spark, texts)))
    sets = {i: shingles(t) for i, t in enumerate(texts)}
    want = brute_components(sets)
    assert len(got) == len(texts)
    for i in want:
        assert got[i]["n_shingles"] == len(sets[i])
        assert got[i]["component_id"] == want[i], (i, texts[i])
        assert got[i]["kept"] == (want[i] == i)


@pytest.mark.parametrize("n", [1, 2, 3, 10, 200, 5000])
def test_signature_agrees_in_proportion(n):
    rng = np.random.default_rng(n)
    both = rng.integers(0, 2**63, 8 * n, dtype=np.uint64)
    a, b = np.unique(both[:7 * n]), np.unique(both[n:])  # resemblance 6/8
    agree = np.mean([m.signature(a, 1536) == m.signature(b, 1536)])
    assert abs(agree - len(np.intersect1d(a, b)) / len(np.union1d(a, b))) < 0.06


def test_probes_and_ranks_choose_alike():
    few = np.unique(np.random.default_rng(1).integers(0, 2**63, 40, dtype=np.uint64) * np.uint64(2))
    sig = m.signature(few, 384)
    order, _ = m._orders(384)
    bins = ((few >> np.uint64(32)) * np.uint64(384) >> np.uint64(32)).astype(int)
    smallest = {b: few[bins == b].min() for b in set(bins.tolist())}
    for i in range(384):
        want = smallest.get(i) if i in smallest else next(smallest[j] for j in order[i].tolist() if j in smallest)
        assert sig[i] == want


def test_ids_null_repeated_and_extra_columns(spark):
    long = "a b c d e f g h i j"
    df = docs(spark, [long, long, "other words here now ok yes", long, None],
              [7, 7, 7, None, None]).selectExpr("*", "1 as n_shingles", "2 as node", "3 as key")
    rows = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in m.near_duplicates(df).collect()), key=str)
    assert rows == sorted([(7, 6, 7, True), (7, 6, 7, True), (7, 2, 7, True), (None, 6, 7, False),
                           (None, 0, None, True)], key=str)


@pytest.mark.parametrize("own", [4, 9, 14])
def test_templates_that_are_not_similar_do_not_meet(spark, own):
    """Hundreds of documents of one template, each with ``own`` words of its own at two
    places: with few they are near copies, with more they share buckets but no link."""
    rng = random.Random(own)
    base = sentence(rng, 90, 10**6).split()
    texts = [" ".join(base[:30] + [f"o{k}-{i}" for i in range(own)] + base[30:60] + [f"p{k}-{i}" for i in range(own)] + base[60:])
             for k in range(300)]
    sets = {i: shingles(t) for i, t in enumerate(texts)}
    got = {r.doc_id: r.component_id for r in m.near_duplicates(docs(spark, texts)).collect()}
    assert got == brute_components(sets)
    nodes = spark.createDataFrame([(i, len(v), i) for i, v in sets.items()], "node bigint, n bigint, component bigint")
    whole = spark.createDataFrame([(i, [hash(x) for x in v]) for i, v in sets.items()], "node bigint, shingles array<bigint>")
    pairs = m._prefix_pairs(nodes, whole, 75, cell=16)
    n, k = len(sets[0]), len(sets[0] & sets[1])
    if 100 * k < 75 * (2 * n - k):  # no candidate among 44,850 pairs
        assert pairs.count() == 0
    else:
        assert pairs.count() == 300 * 299 // 2


def test_prefix_pairs_hold_every_similar_pair(spark):
    rng = random.Random(2)
    sets = {}
    for node in range(240):  # some near an earlier one, many with frequent members
        near = set(rng.choice(list(sets.values()))) if sets and rng.random() < 0.6 else set()
        for x in rng.sample(sorted(near), min(len(near), rng.choice([0, 1, 3]))):
            near.remove(x)
        sets[node] = near | {rng.randrange(60) for _ in range(rng.choice([1, 2, 8]))} | {rng.randrange(10**9) for _ in range(rng.choice([0, 2]))}
    component = {k: rng.randrange(40) for k in sets}
    want = {(a, b) for a in sets for b in sets if a < b and component[a] != component[b]
            and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    nodes = spark.createDataFrame([(k, len(v), component[k]) for k, v in sets.items()], "node bigint, n bigint, component bigint")
    whole = spark.createDataFrame([(k, list(v)) for k, v in sets.items()], "node bigint, shingles array<bigint>")
    got = [tuple(sorted(r)) for r in m._prefix_pairs(nodes, whole, 75, cell=8).collect()]
    assert len(got) == len(set(got)) and want <= set(got) and len(want) > 30
    assert all(component[a] != component[b] for a, b in got)


def test_rows_of_one_id_are_read_once_for_their_sets(spark, monkeypatch):
    rng = random.Random(4)
    base = sentence(rng, 100)
    rows = [(None, f"{base} tail {k}") for k in range(200)]
    seen = []
    real = m._sets
    monkeypatch.setattr(m, "_sets", lambda d, size: (seen.append(d.count()), real(d, size))[1])
    out = m.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert seen == [200] and len(out) == 200


def test_empty_table(spark):
    out = m.near_duplicates(docs(spark, []))
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"] and out.count() == 0
