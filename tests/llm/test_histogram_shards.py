"""Histogram sort against a plain sort."""

import hashlib
import random
import zlib

import pytest

from playstats.llm import histogram_shards as hs
from playstats.llm.common import shared_path, stored
from tests.llm import helpers

SCHEMA = "doc_id bigint, text string, shard string, key int"


def brute(rows, shards):
    def place(r):
        return (hashlib.md5((r[1] or "").encode()).digest(), r[1] is not None, r[0] is not None, r[0] or 0)

    rows = sorted(rows, key=place)
    sizes = [len((r[1] or "").encode()) + 1 for r in rows]
    total, start, slots, out = sum(sizes), 0, [0] * shards, []
    for r, size in zip(rows, sizes):
        shard = shards * (2 * start + size) // (2 * total)
        out.append((str(r[0]), size, zlib.crc32((r[1] or "").encode()), "bytes", shard, slots[shard], None))
        slots[shard] += 1
        start += size
    return sorted(out, key=repr)


def got(df):
    return sorted(((str(r[0]), *r[1:]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("shards", [1, 5, 16])
def test_equals_a_plain_sort(spark, shards):
    rng = random.Random(shards)
    texts = ["", None, " ", "caf\u00e9"] * 3 + [helpers.sentence(rng, rng.randrange(1, 80)) for _ in range(150)]
    rows = [(rng.choice([None, -5, k, 1 << 62]), t, "x", 1) for k, t in enumerate(texts)]
    rows += [(7, "one row with many copies", "x", 1)] * 90        # every copy of one row
    rows += [(k, "one text with many ids", "x", 1) for k in range(90)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert got(hs.sharded(df, shards)) == brute(rows, shards)


def test_one_row_holds_most_of_the_table(spark):
    rows = [(3, "hot", "x", 1)] * 400 + [(k, f"t{k}", "x", 1) for k in range(40)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(hs.sharded(df, 8)) == brute(rows, 8)
    # its copies are dealt to many partitions
    pieces = hs.shard_rows(df, 8).filter("text = 'hot'").rdd.glom().map(len).collect()
    assert sum(pieces) == 400 and max(pieces) <= 60


def test_a_row_larger_than_a_shard(spark):
    rows = [(1, "x" * 300_000, "x", 1)] + [(k, f"t{k}", "x", 1) for k in range(2, 30)]
    assert got(hs.sharded(spark.createDataFrame(rows, SCHEMA), 16)) == brute(rows, 16)


def test_fewer_rows_than_shards_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a", "x", 1), (None, None, "x", 1)], SCHEMA)
    assert got(hs.sharded(df, 16)) == brute([(1, "a"), (None, None)], 16)
    assert hs.sharded(df.limit(0), 16).collect() == []


def test_files_hold_the_texts(spark):
    rows = [(k, f"text {k}", "x", 1) for k in range(50)] + [(50, None, "x", 1)]
    path = shared_path(spark, "shards-test")
    hs.write_shards(spark.createDataFrame(rows, SCHEMA), path, 4)
    back = hs.read_shards(spark, path).collect()
    assert sorted((r.doc_id, r.text) for r in back) == sorted(r[:2] for r in rows)
    assert {r.shard for r in back} == {0, 1, 2, 3}


def test_tolerance_ends_the_search_early(spark):
    rng = random.Random(1)
    rows = [(k, helpers.sentence(rng, rng.randrange(5, 40)), "x", 1) for k in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA)
    text, doc_id = hs.F.col("text"), hs.F.col("doc_id")
    keys = stored(df.select(hs.sort_key(text, doc_id).alias("key"), hs.row_size(text).alias("size")), "keys-test")
    total = sum(len(r[1]) + 1 for r in rows)
    exact, rounds = hs.splitters(keys, 8, 1, probes=4)
    loose, fewer = hs.splitters(keys, 8, 1, tolerance=0.05, probes=4)
    assert fewer < rounds <= 60
    for cuts, off in ((exact, 200), (loose, 0.05 * total / 8)):
        assert [abs(c.n_bytes - (i + 1) * total / 8) <= off for i, c in enumerate(cuts)] == [True] * 7
