"""One key holds a third of all rows: every keyed operator must still return
whole, exact results (nothing dropped, capped or duplicated)."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from playstats.operators.keys import duplicate_members, groups_larger_than, keep_last
from playstats.operators.lookup import lookup_song_artist, song_artist_catalog
from playstats.plans import reports
from playstats.sinks import dml

N = 9_000


@pytest.fixture()
def hot_plays(spark):
    """Plays where user 7 and song 'Hot' account for a third of the rows."""
    hot = F.col("id") % 3 == 0
    return spark.range(N).select(
        F.col("id").alias("songplay_id"), F.col("id").alias("time_id"),
        F.when(hot, F.lit(7)).otherwise(F.col("id") % 50).cast("int").alias("user_id"),
        F.when(hot, F.lit("Hot")).otherwise(F.concat(F.lit("S"), (F.col("id") % 40).cast("string"))).alias("song"),
        F.lit("Band").alias("artist"), F.lit(100.0).cast("decimal(28,10)").alias("length"),
        F.col("id").alias("ts"), F.when(F.col("id") % 2 == 0, "paid").otherwise("free").alias("level"),
        F.when(hot, F.lit(None).cast("string")).otherwise(F.lit("Paris")).alias("location"))


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("rows_per_bucket", [100, 1_000_000])
def test_lookup_with_hot_song(spark, hot_plays, rows_per_bucket):
    songs = spark.createDataFrame([("SO_HOT", "Hot", "AR1", 100.0), ("SO_1", "S1", "AR1", 100.0)],
                                  "song_id string, title string, artist_id string, duration double") \
        .withColumn("duration", F.col("duration").cast("decimal(28,10)"))
    artists = spark.createDataFrame([("AR1", "Band")], "artist_id string, name string")
    cat = song_artist_catalog(songs, artists)
    got = lookup_song_artist(hot_plays, cat, rows_per_bucket=rows_per_bucket)
    plain = hot_plays.join(cat.withColumnsRenamed({"name": "artist", "title": "song", "duration": "length"}),
                           ["artist", "song", "length"], "left").select(*got.columns)
    assert got.count() == N and _same(got, plain)
    assert got.filter(F.col("song_id") == "SO_HOT").count() == N // 3


def test_keep_last_and_upsert_with_hot_user(spark, hot_plays):
    last = keep_last(hot_plays.select("user_id", "level", "ts"), ["user_id"], ["ts"])
    w = Window.partitionBy("user_id").orderBy(F.desc("ts"))
    expect = (hot_plays.select("user_id", "level", "ts").withColumn("r", F.row_number().over(w))
              .filter("r = 1").drop("r"))
    assert _same(last, expect)
    target = spark.createDataFrame([(7, "A", "B", "F", "free")],
                                   "user_id int, first_name string, last_name string, gender string, level string")
    batch = hot_plays.select("user_id", F.lit("N").alias("first_name"), F.lit("L").alias("last_name"),
                             F.lit("M").alias("gender"), "level", "ts")
    merged = {r.user_id: r for r in dml.upsert(target, batch, "user_id", ["level"], ["ts"]).collect()}
    assert len(merged) == 50 and merged[7].first_name == "A"
    assert merged[7].level == ("paid" if (N - 3) % 2 == 0 else "free")


def test_duplicates_with_hot_group(spark, hot_plays):
    df = hot_plays.select("location", "level")
    assert duplicate_members(df).count() == N                 # every row is in a repeated group
    assert groups_larger_than(df, ["location"], N // 2).count() == N - N // 3


def test_reports_with_hot_user_and_null_location(spark, hot_plays):
    users = spark.range(50).select(F.col("id").cast("int").alias("user_id"), F.lit("U").alias("first_name"),
                                   F.col("id").cast("string").alias("last_name"))
    top = reports.top_k_users(hot_plays, users, 3).collect()
    assert top[0].user_id == 7
    assert top[0].songplays_counter == hot_plays.filter("user_id = 7").count()
    loc = {r.location: r.songplay_counter for r in reports.plays_by_location(hot_plays).collect()}
    assert loc == {None: N // 3, "Paris": N - N // 3}


def test_identical_hot_rows_expand_exactly_and_spread(spark):
    from playstats.operators.keys import duplicate_members, expand_counts

    df = spark.range(6000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("a"))
    got = duplicate_members(df)
    assert got.count() == 2000 and got.filter("a = -1").count() == 2000
    rows = spark.createDataFrame([("x", 10), ("y", 1), ("z", 7)], "v string, n long")
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = expand_counts(rows, "n", chunk=3)
        assert sorted(r.v for r in out.collect()) == ["x"] * 10 + ["y"] + ["z"] * 7
        hot = expand_counts(spark.createDataFrame([("h", 3000)], "v string, n long"), "n", chunk=100)
        per_task = hot.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert sum(r["count"] for r in per_task) == 3000
        assert len(per_task) >= 4 and max(r["count"] for r in per_task) < 1500   # 30 chunks spread
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_reports_on_empty_plays(spark):
    sp = spark.createDataFrame([], "songplay_id long, time_id long, user_id int, location string")
    times = spark.createDataFrame([], "time_id long, hour int")
    users = spark.createDataFrame([], "user_id int, first_name string, last_name string")
    assert reports.plays_by_hour(sp, times).count() == 0
    assert reports.plays_by_location(sp).count() == 0          # no division by a zero total
    assert reports.top_k_location_share(sp, 10).count() == 0
    assert reports.top_k_users(sp, users, 10).count() == 0
    assert reports.total_plays(sp).collect()[0].total_songplays == 0


def _per_task(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]


def test_repeated_log_line_is_spread(spark, tmp_path):
    """A line repeated a third of the time is one row before the range step."""
    import json

    from playstats.plans import star
    from tests.conftest import play, write_lines

    lines = [play(1541121934796 + (0 if i % 3 == 0 else i), "88", "Ann", "Lee", "F", "free", item=0 if i % 3 == 0 else i)
             for i in range(3000)]
    write_lines(str(tmp_path / "a.json"), lines)
    raw = star.read_log_data(spark, str(tmp_path), distinct=False, keep_extra=True)
    ordered = star.ordered_plays(raw, num_partitions=8)
    assert ordered.count() == len({json.dumps(x, sort_keys=True) for x in lines}) == 2001
    assert max(_per_task(ordered)) < 600


def test_quartiles_with_one_value_in_a_third(spark):
    import numpy as np

    from playstats.operators import profile

    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit(5.0)).when(F.col("id") % 1000 == 1, F.lit(float("nan")))
                                    .otherwise((F.col("id") % 7).cast("double")).alias("x"),
                                    F.lit(None).cast("double").alias("none"))
    values = np.array([r.x for r in df.collect()])
    values = values[~np.isnan(values)]
    got = {r.column_name: r for r in profile.profile_numeric(df, ["x", "none"]).collect()}
    r = got["x"]
    assert r["count"] == len(values) and abs(r["mean"] - values.mean()) < 1e-9
    assert abs(r["std"] - values.std(ddof=1)) < 1e-9 and (r["min"], r["max"]) == (0.0, 6.0)
    assert [r.p25, r.p50, r.p75] == list(np.quantile(values, [0.25, 0.5, 0.75]))
    assert got["none"]["count"] == 0 and got["none"].p50 is None
    # every distinct value is one row after the counting step
    assert profile.value_counts(df.unpivot([], ["x"], "column_name", "value")).count() == 8


def test_hot_artist_join(spark):
    from playstats.operators import joins, lookup

    songs = spark.range(6000).select(F.col("id").cast("string").alias("song_id"), F.lit("t").alias("title"),
                                     F.when(F.col("id") % 3 == 0, "A0").otherwise(F.concat(F.lit("A"), F.col("id") % 50)).alias("artist_id"))
    artists = spark.range(50).select(F.concat(F.lit("A"), F.col("id")).alias("artist_id"), F.col("id").cast("string").alias("name"))
    got = lookup.join_songs_artists(songs, artists)
    assert got.columns == ["artist_id", "song_id", "title", "name"] and got.count() == 6000
    assert joins.hot_keys(songs, ["artist_id"], 1000).count() == 1
