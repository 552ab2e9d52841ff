"""End-to-end: two JSON folders -> five Parquet tables -> reports."""

import pytest
from pyspark.sql import functions as F

from playstats.operators.quality import QualityError
from playstats.plans import reports, star


@pytest.fixture(scope="module")
def built(spark, song_tree, log_tree, tmp_path_factory):
    return star.run_pipeline(spark, song_tree, log_tree, str(tmp_path_factory.mktemp("star") / "out"))


def test_dimensions(built):
    songs = {r.song_id: r for r in built["songs"].collect()}
    assert sorted(songs) == ["SOA", "SOB", "SOC", "SOD", "SOE"]
    assert songs["SOC"].title == "Tabhere" and songs["SOB"].title == "007"
    artists = {r.artist_id: r for r in built["artists"].collect()}
    assert sorted(artists) == ["AR1", "AR2", "AR3"]
    assert artists["AR1"].location is None and artists["AR1"].latitude is None
    assert artists["AR2"].location == 'Town, "Q"'
    users = {r.user_id: r for r in built["users"].collect()}
    assert sorted(users) == [12, 13, 14, 15, 88]
    assert users[88].level == "free"                  # last by event time, not file order
    assert users[12].last_name is None


def test_fact_and_times(built):
    sp, times = built["songplays"], built["times"]
    assert sp.count() == 8                             # NextSong only; 88 vs "88" copy collapsed
    assert times.count() == 8
    assert sp.join(times, "time_id").count() == 8      # 1:1
    assert sp.select("songplay_id").distinct().count() == 8
    ids = sorted(r.songplay_id for r in sp.collect())
    assert ids == list(range(8))
    matched = {r.user_id: (r.song_id, r.artist_id) for r in sp.filter(F.col("song_id").isNotNull()).collect()}
    assert matched == {12: ("SOA", "AR1"), 15: ("SOD", "AR3")}
    same_ms = sp.join(times, "time_id").filter(F.col("user_id").isin(12, 13)).select("start_time").distinct()
    assert same_ms.count() == 1                        # two plays, one second, two ids


def test_reports(built):
    sp, users, times = built["songplays"], built["users"], built["times"]
    hours = [tuple(r) for r in reports.plays_by_hour(sp, times).collect()]
    assert hours == [(0, 1), (1, 5), (2, 1), (3, 1)]  # only hours with plays, in order
    loc = reports.plays_by_location(sp).collect()
    assert sum(r.songplay_counter for r in loc) == 8
    assert abs(sum(r.songplays_percent for r in loc) - 100.0) < 1e-9
    assert [(r.location, r.songplay_counter) for r in loc] == [("Paris", 7), (None, 1)]
    top = reports.top_users(sp, users).collect()
    assert top[0].user_id == 88 and top[0].songplays_counter == 4
    assert top[-1].user_fullname is None               # NULL name sorted last
    share = reports.top_k_location_share(sp, 10).collect()
    assert sum(r.share_percent for r in share) in (99, 100, 101)
    assert reports.total_plays(sp).collect()[0].total_songplays == 8


def test_catalog_tables_without_buckets(spark, song_tree, log_tree, tmp_path):
    from playstats.plans import catalog

    db = catalog.fresh_table_name("plain")
    t = star.run_pipeline(spark, song_tree, log_tree, str(tmp_path / "plain"), database=db)
    assert spark.table(f"{db}.times").count() == 8 and spark.table(f"{db}.songplays").count() == 8
    assert t["users"].count() == 5


def test_rerun_is_idempotent(spark, song_tree, log_tree, tmp_path):
    out = str(tmp_path / "again")
    first = star.run_pipeline(spark, song_tree, log_tree, out)["songplays"].count()
    assert star.run_pipeline(spark, song_tree, log_tree, out)["songplays"].count() == first


def test_strict_user_id_and_conflict_policy(spark, song_tree, tmp_path):
    from conftest import play, song, write_lines

    logs = tmp_path / "bad_logs"
    write_lines(str(logs / "x.json"), [play(1, "abc", "A", "B", "F", "free")])
    with pytest.raises(Exception, match="not a number"):
        star.build_times(star.prepare_plays(star.read_log_data(spark, str(logs)))).collect()
    songs = tmp_path / "conflict"
    write_lines(str(songs / "a.json"), [song("S1", "t", "AR1", 1, 1.0, "One", "Paris")])
    write_lines(str(songs / "b.json"), [song("S2", "u", "AR1", 1, 1.0, "One", "Lyon")])
    raw = star.read_song_data(spark, str(songs))
    assert star.build_artists(raw, on_conflict="quarantine").count() == 1
    assert star.build_artists(raw, on_conflict="keep_all").count() == 2
    with pytest.raises(QualityError):
        star.build_artists(raw)


def test_bucketed_star_joins_without_shuffle(spark, song_tree, log_tree, tmp_path):
    from playstats.plans import catalog

    db = catalog.fresh_table_name("star")
    t = star.run_pipeline(spark, song_tree, log_tree, str(tmp_path / "bucketed"), database=db, buckets=4)
    assert t["songplays"].count() == 8 and t["times"].count() == 8
    q = reports.plays_by_hour(t["songplays"], t["times"])
    assert [tuple(r) for r in q.collect()] == [(0, 1), (1, 5), (2, 1), (3, 1)]
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        join = t["songplays"].join(t["times"], "time_id")
        plan = join._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan   # co-located buckets
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_sql_reports_equal_dataframe_reports(spark, built):
    from decimal import Decimal

    from playstats.plans import sql_reports as q

    q.register_star(spark, built)
    sp, users, times = built["songplays"], built["users"], built["times"]
    assert q.run(spark, q.PLAYS_BY_HOUR).collect() == reports.plays_by_hour(sp, times).collect()
    assert q.run(spark, q.PLAYS_BY_LOCATION).collect() == reports.plays_by_location(sp).collect()
    assert q.run(spark, q.TOP_USERS).collect() == reports.top_users(sp, users).collect()
    hit = q.run(spark, q.SONG_LOOKUP, artist="Dup Artist", title="Same", duration=Decimal("200")).collect()
    assert [tuple(r) for r in hit] == [("SOD", "AR3")]


def test_plays_dedup_and_order_share_one_shuffle(spark, log_tree):
    raw = star.read_log_data(spark, log_tree, distinct=False, keep_extra=True)
    plan = star.ordered_plays(raw)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "rangepartitioning" in plan
    assert "FileScan parquet" in plan and "from_json" not in plan     # lines are not parsed again
    assert star.ordered_plays(raw).count() == 8


def test_command_line(spark, song_tree, log_tree, tmp_path, capsys):
    from playstats.__main__ import main

    from playstats.plans import catalog

    db = catalog.fresh_table_name("cli")
    assert main(["reset", db, str(tmp_path / "wh")]) == 0
    assert "table_name=songplays" in capsys.readouterr().out
    out = str(tmp_path / "cli")
    assert main(["etl", song_tree, log_tree, out]) == 0
    assert "songplays: 8 rows" in capsys.readouterr().out
    assert main(["report", out, "--top", "3"]) == 0
    text = capsys.readouterr().out
    assert "== plays per hour" in text and "hour=1 | songplays_counter=5" in text
    assert "user_id=88" in text and "location=Paris | songplay_counter=7 | share_percent=88" in text
    assert main(["profile", out]) == 0
    text = capsys.readouterr().out
    assert "== users: text" in text and "column_name=level" in text and "== times: numbers" in text


def test_full_checks_find_duplicates_and_orphans(spark, built):
    from playstats.operators import quality

    quality.check_star(built)
    sp = built["songplays"]
    twice = sp.withColumn("songplay_id", F.greatest("songplay_id", F.lit(1).cast("long")))
    with pytest.raises(quality.QualityError):                  # ids 1, 1, 2, 3, ...
        quality.check_star({**built, "songplays": twice})
    with pytest.raises(quality.QualityError):
        quality.check_star({**built, "songplays": sp.withColumn("time_id", F.col("time_id") + 1000)})


def test_bad_lines_stop_or_are_set_aside(spark, song_tree, tmp_path):
    from tests.conftest import play, write_lines

    good = play(1541121934796, "88", "Ann", "Lee", "F", "free")
    write_lines(str(tmp_path / "log" / "a.json"), [good, {**good, "ts": "abc"}, {**good, "sessionId": 1.5}],
                raw_lines=['{"page": "NextSong", "ts": 15411', "[1]", "no json", ""])
    with pytest.raises(Exception, match="(?i)malformed|convert"):
        star.prepare_plays(star.read_log_data(spark, str(tmp_path / "log"), distinct=False, keep_extra=True)).count()
    out = str(tmp_path / "out")
    tables = star.run_pipeline(spark, song_tree, str(tmp_path / "log"), out, on_bad="quarantine")
    assert tables["songplays"].count() == 1
    lines = [r.line for r in spark.read.parquet(f"{out}/quarantine/log_lines").collect()]
    assert len(lines) == 5 and "no json" in lines and any('"abc"' in x for x in lines)
    assert spark.read.parquet(f"{out}/quarantine/song_lines").count() == 0


def test_conflicting_ids_stop_or_are_set_aside(spark, log_tree, tmp_path):
    from playstats.operators.quality import QualityError
    from tests.conftest import song, write_lines

    write_lines(str(tmp_path / "songs" / "a.json"),
                [song("SO1", "Other", "AR1", 1, 1.0, "Artist 1"), song("SOA", "Song A", "AR1", 2001, 218.93179, "Artist One"),
                 song("SOA", "Song B", "AR1", 2001, 5.0, "Artist One")])
    with pytest.raises(QualityError):
        star.run_pipeline(spark, str(tmp_path / "songs"), log_tree, str(tmp_path / "o1"))
    out = str(tmp_path / "o2")
    tables = star.run_pipeline(spark, str(tmp_path / "songs"), log_tree, out, on_conflict="quarantine")
    assert tables["artists"].count() == 1 and tables["songs"].count() == 2
    assert [r.name for r in spark.read.parquet(f"{out}/quarantine/artists").collect()] == ["Artist One"]
    assert spark.read.parquet(f"{out}/quarantine/songs").count() == 1
    # plays under the spelling that was set aside still find their song
    assert tables["songplays"].filter("song_id = 'SOA'").count() == 1
    assert spark.read.parquet(f"{out}/quarantine/user_variants").count() == 0


def test_lenient_user_ids_are_reported(spark, tmp_path):
    from tests.conftest import play, write_lines

    write_lines(str(tmp_path / "a.json"), [play(1541121934796 + i, u, "A", "B", "F", "free") for i, u in enumerate(["7", "x", "x", "9"])])
    raw = star.read_log_data(spark, str(tmp_path), distinct=False, keep_extra=True)
    plays = star.prepare_plays(raw, strict_user_id=False)
    assert sorted(str(r.userId) for r in plays.select("userId").collect()) == ["7", "9", "None", "None"]
    assert [tuple(r) for r in star.rejected_plays(plays).collect()] == [("x", 2)]
    with pytest.raises(Exception, match="not a number"):
        star.prepare_plays(raw).count()

