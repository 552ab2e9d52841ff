"""Bloom filter of keys, and the lookup that uses it."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from playstats.operators import lookup
from playstats.operators.bloom import BITS_PER_KEY, BloomFilter


def test_no_key_is_refused_and_few_others_pass(spark):
    table = spark.range(2000).select(F.concat(F.lit("k"), "id").alias("a"), (F.col("id") / 4).alias("b"))
    bloom = BloomFilter.of(table, ["a", "b"])
    assert bloom.n_bits >= 2000 * BITS_PER_KEY
    assert table.filter(bloom.might_hold(table, ["a", "b"])).count() == 2000
    other = spark.range(2000, 12_000).select(F.concat(F.lit("k"), "id").alias("a"), (F.col("id") / 4).alias("b"))
    assert other.filter(bloom.might_hold(other, ["a", "b"])).count() < 300
    assert BloomFilter.of(table, ["a", "b"], max_bytes=100) is None


def test_values_that_are_equal_hash_alike(spark):
    table = spark.createDataFrame([(1, 0.0, "x"), (2, 2.5, None), (None, 1.0, "y")], "a int, b double, c string")
    bloom = BloomFilter.of(table, ["a", "b", "c"])
    probe = spark.createDataFrame([(1, Decimal("0.00"), "x"), (2, Decimal("2.50"), None)], "a bigint, b decimal(9,2), c string")
    assert [r.a for r in probe.filter(bloom.might_hold(probe, ["a", "b", "c"])).collect()] == [1]
    minus = spark.createDataFrame([(1, -0.0, "x")], "a bigint, b double, c string")
    assert minus.filter(bloom.might_hold(minus, ["a", "b", "c"])).count() == 1
    empty = BloomFilter.of(table.limit(0), ["a"])
    assert probe.filter(empty.might_hold(probe, ["a"])).count() == 0


@pytest.mark.parametrize("filter_bytes", [1 << 20, 0])
def test_lookup_beyond_a_broadcast(spark, filter_bytes):
    rng = random.Random(3)
    catalog = spark.createDataFrame([(f"n{k}", f"t{k}", k / 4, f"S{k}", f"A{k}") for k in range(300)],
                                    "name string, title string, duration double, song_id string, artist_id string")
    rows = [(i, *rng.choice([(f"n{k}", f"t{k}", k / 4), (f"n{k}", "other", k / 4), (None, f"t{k}", 1.0), (f"n{k}", f"t{k}", None)]))
            for i, k in enumerate([rng.randrange(600) for _ in range(2000)] + [7] * 3000)]
    plays = spark.createDataFrame(rows, "id int, artist string, song string, length double").repartition(4)
    want = {r[0]: f"S{r[1][1:]}" if r[1] and r[3] is not None and r[2] == f"t{r[1][1:]}" and int(r[1][1:]) < 300 else None for r in rows}
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = lookup.lookup_song_artist(plays, catalog, rows_per_bucket=500, filter_bytes=filter_bytes)
        got = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert out.columns == ["id", "artist", "song", "length", "song_id", "artist_id"]
    assert len(got) == len(rows) and {r.id: r.song_id for r in got} == want
    assert ("getbit" in plan) == (filter_bytes > 0)


def test_small_catalogs_need_no_count_of_plays(spark, monkeypatch):
    monkeypatch.setattr(lookup, "skew_safe_join", lambda *a, **k: pytest.fail("the plays were counted"))
    catalog = spark.createDataFrame([("n", "t", 1.0, "S", "A")], "name string, title string, duration double, song_id string, artist_id string")
    plays = spark.createDataFrame([(1, "n", "t", 1.0), (2, "n", None, 1.0)], "id int, artist string, song string, length double")
    assert sorted((r.id, r.song_id) for r in lookup.lookup_song_artist(plays, catalog.coalesce(1), ).collect()) == [(1, "S"), (2, None)]
