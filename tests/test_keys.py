import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from playstats.operators.keys import (assign_surrogate_id, distinct_rows, distinct_stored, duplicate_members, duplicate_summary,
                                     groups_larger_than, keep_first, keep_last, patch_by_key)
from playstats.operators.ordering import head_tail, slice_rows
from playstats.scratch import scratch_path


def test_keep_last_by_event_time_not_file_order(spark):
    df = spark.createDataFrame(
        [(88, "free", 3), (88, "paid", 2), (88, "free", 1), (7, "paid", 5), (7, "free", 5)],
        "user_id int, level string, ts long")
    got = {r.user_id: r.level for r in keep_last(df, ["user_id"], ["ts"]).collect()}
    assert got[88] == "free"
    assert got[7] == "paid"                     # tie on ts: larger remaining columns win, fixed
    first = {r.user_id: r.level for r in keep_first(df, ["user_id"], ["ts"]).collect()}
    assert first[88] == "free" and first[7] == "free"


def test_keep_last_plans_partial_aggregation(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("ts"),
                                  F.col("id").cast("string").alias("v"))
    plan = keep_last(df, ["k"], ["ts"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan           # a hot key shrinks before the shuffle


def test_surrogate_id_matches_row_number_and_is_stable(spark):
    df = spark.range(10_000).select(((F.col("id") * 7919) % 10_007).alias("ts"), F.col("id").alias("x"))
    ids = assign_surrogate_id(df, ["ts", "x"], "rid")
    expect = df.withColumn("rid", F.row_number().over(Window.orderBy("ts", "x")) - 1)
    assert ids.exceptAll(expect).count() == 0 and ids.count() == 10_000
    assert ids.agg(F.min("rid"), F.max("rid"), F.count_distinct("rid")).collect()[0] == (0, 9999, 10000)
    again = ids.join(ids.withColumnRenamed("rid", "rid2"), ["ts", "x"])
    assert again.filter(F.col("rid") != F.col("rid2")).count() == 0


def test_surrogate_id_hot_value_is_split(spark):
    # a third of the rows share one timestamp: the range partitioner still spreads them
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id")).alias("ts"),
                                  F.col("id").alias("x"))
    ids = assign_surrogate_id(df, ["ts", "x"], "rid", num_partitions=6)
    sizes = ids.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert max(r["count"] for r in sizes) < 1500
    assert ids.select("rid").distinct().count() == 3000


def test_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c"), (None, "c"), (3, None)],
                               "k int, v string")
    assert sorted(map(tuple, duplicate_members(df).collect()), key=str) == \
        sorted([(1, "a"), (1, "a"), (None, "c"), (None, "c")], key=str)
    assert tuple(duplicate_summary(df).collect()[0]) == (6, 4, 2)
    assert groups_larger_than(df, ["k"], 1).count() == 4


def test_patch_by_key_only_patches(spark):
    df = spark.createDataFrame([(1, "x", 1.0), (2, "y", 2.0), (3, "z", 3.0)], "id long, a string, d double")
    patch = spark.createDataFrame([(2, "P", None), (9, "Q", 9.0)], "id long, a string, d double")
    got = sorted(map(tuple, patch_by_key(df, patch, "id", ["a", "d"]).collect()))
    assert got == [(1, "x", 1.0), (2, "P", None), (3, "z", 3.0)]


def test_head_tail_and_slices(spark):
    df = spark.range(20).select(F.col("id"), (F.col("id") * 2).alias("v"))
    assert [r.id for r in head_tail(df, 3, ["id"]).collect()] == [0, 1, 2, 19, 18, 17]
    assert [r.id for r in slice_rows(df, ["id"], 3, 6).orderBy("id").collect()] == [3, 4, 5]
    assert sorted(r.id for r in slice_rows(df, ["id"], 15).collect()) == [15, 16, 17, 18, 19]


def _same_rows(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_skew_safe_join_spreads_hot_key_and_keeps_rows(spark):
    from playstats.operators.joins import skew_safe_join

    big = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 100).alias("k"), "id")
    big = big.union(spark.createDataFrame([(None, -1)], "k long, id long"))
    small = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    keys = {"spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.enabled": "false",
            "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        got = skew_safe_join(big, small, ["k"], "left", rows_per_bucket=700)
        plain = big.join(small, "k", "left")
        unsalted = skew_safe_join(big, small, ["k"], "left")
        assert _same_rows(unsalted, plain) and unsalted.count() == 30_001
        assert got.count() == plain.count() == 30_001
        assert got.exceptAll(plain).count() == 0 and plain.exceptAll(got).count() == 0
        per_task = got.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert max(r["count"] for r in per_task) < 10_000 // 2   # the 10k hot rows are split
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_skew_safe_join_spreads_null_keys(spark):
    from playstats.operators.joins import skew_safe_join

    big = spark.range(20_000).select(
        F.when(F.col("id") % 5 != 0, F.lit(None).cast("long")).otherwise(F.col("id") % 100).alias("k"), "id")
    small = spark.range(100).select(F.col("id").alias("k"), (F.col("id") + 1).alias("v"))
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.enabled": "false",
            "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        got = skew_safe_join(big, small, ["k"], "left", rows_per_bucket=500)
        plain = big.join(small, "k", "left")
        assert _same_rows(got, plain) and got.count() == 20_000
        assert got.filter(F.col("v").isNull()).count() == 16_000
        per_task = got.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert max(r["count"] for r in per_task) < 16_000 // 4      # the NULL keys are spread
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_every_hot_key_is_split(spark):
    from playstats.operators.joins import hot_keys, skew_safe_join

    # 12,000 keys of 4 rows each, all above 2 rows a bucket
    big = spark.range(48_000).select((F.col("id") % 12_000).alias("k"), "id")
    got = hot_keys(big, ["k"], rows_per_bucket=2)
    assert got.count() == 12_000 and got.filter("_buckets <> 2").count() == 0
    small = spark.range(12_000).select(F.col("id").alias("k"), (-F.col("id")).alias("v"))
    out = skew_safe_join(big, small, ["k"], "inner", rows_per_bucket=2)
    assert out.count() == 48_000 and out.filter("v <> -k").count() == 0


def test_hot_keys_threshold(spark):
    from playstats.operators.joins import hot_keys

    # keys 1..3 hold 600, 700, 800 of 20,100 rows (< 5 % each); the rest are single rows
    parts = [spark.range(n).select(F.lit(k).cast("long").alias("k")) for k, n in ((1, 600), (2, 700), (3, 800))]
    big = parts[0].union(parts[1]).union(parts[2]).union(spark.range(100, 18_100).select(F.col("id").alias("k")))
    assert hot_keys(big, ["k"]).count() == 0
    got = {r.k: r._buckets for r in hot_keys(big, ["k"], rows_per_bucket=300).collect()}
    assert got == {1: 2, 2: 3, 3: 3}


def test_empty_inputs(spark):
    from playstats.operators.joins import skew_safe_join
    from playstats.operators.keys import expand_counts
    from playstats.operators.profile import profile_numeric, profile_text

    empty = spark.createDataFrame([], "k long, ts long, v string")
    assert assign_surrogate_id(empty, ["ts", "k"], "rid").count() == 0
    assert keep_last(empty, ["k"], ["ts"]).count() == 0
    assert duplicate_members(empty).count() == 0
    small = spark.createDataFrame([(1, "x")], "k long, w string")
    assert skew_safe_join(empty, small, ["k"], "left").count() == 0
    assert expand_counts(spark.createDataFrame([], "v string, n long"), "n").count() == 0
    p = {r.column_name: r for r in profile_numeric(empty, ["ts"]).collect()}
    assert p["ts"]["count"] == 0 and p["ts"].p50 is None
    assert profile_text(empty, ["v"]).collect()[0]["count"] == 0


@pytest.mark.parametrize("pivots, sort_rows", [(64, 50_000), (16, 12)])
def test_slices_equal_a_sorted_list(spark, pivots, sort_rows):
    import datetime as dt
    import random

    rng = random.Random(pivots)
    rows = [(rng.choice([None, *range(6)]), dt.datetime(2020, 1, 1 + rng.randrange(3)), rng.choice([None, "a", "b'"]))
            for _ in range(120)] + [(3, dt.datetime(2020, 1, 2), "hot")] * 60
    df = spark.createDataFrame(rows, "k int, t timestamp_ntz, s string").repartition(3)
    none_last = sorted(rows, key=lambda r: tuple((v is None, v) if v is not None else (True, 0) for v in r))
    for start, stop in [(0, None), (17, 130), (100, 110), (150, 500), (200, 210), (5, 5)]:
        got = [tuple(r) for r in slice_rows(df, ["k", "t"], start, stop, pivots, sort_rows).collect()]
        assert sorted(map(repr, got)) == sorted(map(repr, none_last[start:stop])), (start, stop)


def test_slice_stores_nothing_and_sorts_one_range(spark):
    import os

    from playstats.scratch import checkpoint_root

    root = checkpoint_root(spark).removeprefix("file:")
    before = sorted(os.walk(root))
    df = spark.range(100_000).withColumn("v", F.pmod(F.xxhash64("id"), F.lit(1_000_003)))
    out = slice_rows(df, ["v"], 70_000, 70_010, sort_rows=5_000)
    assert sorted(r.v for r in out.collect()) == sorted(r.v for r in df.collect())[70_000:70_010]
    assert sorted(os.walk(root)) == before
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Sort [") == 1 and "Filter" in plan and "Window" not in plan


def _wide(spark):
    rows = [(i % 70, None if i % 3 else "x", float(i % 2)) for i in range(300)]
    rows += [(None, "a", None), (None, None, 1.0), (None, "a", None), (1, "a", float("nan")), (1, "a", float("nan")),
             (2, "z", 0.0), (2, "z", -0.0), (None, None, None), (None, None, None), (None, "b", None)]
    return spark.createDataFrame(rows, "`a.b` int, file string, _row double")  # names like those used inside


def _bag(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


@pytest.mark.parametrize("files", [1, 5])
def test_distinct_stored_equals_distinct(spark, files):
    path = scratch_path(spark, "wide")
    _wide(spark).repartition(files).write.parquet(path)
    table = spark.read.parquet(path)
    want = [r.replace("-0.0", "0.0") for r in _bag(distinct_rows(table))]
    for limit in (64 << 20, 0):  # by place, and where too many places would be broadcast
        got = distinct_stored(spark, path, dropped_bytes=limit)
        assert got.columns == table.columns
        assert sorted(r.replace("-0.0", "0.0") for r in _bag(got)) == sorted(want)


def test_distinct_stored_moves_no_row(spark):
    path = scratch_path(spark, "wide")
    spark.range(1000).selectExpr("id % 990 AS id", "repeat('x', 200) AS filler").write.parquet(path)
    got = distinct_stored(spark, path)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "BroadcastHashJoin" in plan
    assert got.count() == 990


def test_distinct_stored_of_nested_and_empty_tables(spark):
    path, empty = scratch_path(spark, "nested"), scratch_path(spark, "empty")
    spark.sql("SELECT array(CAST(NULL AS INT), 1) AS a UNION ALL SELECT array(1, NULL) UNION ALL SELECT array(1, NULL)"
              ).write.parquet(path)
    assert distinct_stored(spark, path).count() == 2
    _wide(spark).limit(0).write.parquet(empty)
    assert distinct_stored(spark, empty).count() == 0
