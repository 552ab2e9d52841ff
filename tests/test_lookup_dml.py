from decimal import Decimal

import pytest

from playstats.operators.lookup import lookup_point, lookup_song_artist, song_artist_catalog
from playstats.plans import catalog
from playstats.scratch import scratch_path
from playstats.schemas import USERS
from playstats.sinks import dml, writers


@pytest.fixture()
def catalog_df(spark):
    songs = spark.createDataFrame(
        [("SOA", "Song A", "AR1", Decimal("218.93179")), ("SOD", "Same", "AR3", Decimal("200")),
         ("SOC", "Same", "AR3", Decimal("200")), ("SOX", None, "AR1", Decimal("1"))],
        "song_id string, title string, artist_id string, duration decimal(28,10)")
    artists = spark.createDataFrame([("AR1", "Artist One"), ("AR3", "Dup Artist")],
                                    "artist_id string, name string")
    return song_artist_catalog(songs, artists)


def test_lookup_semantics(spark, catalog_df):
    plays = spark.createDataFrame(
        [(1, "Artist One", "Song A", Decimal("218.93179")),
         (2, "Artist One", "Song A", Decimal("218.931791")),      # off by 0.000001
         (3, None, "Song A", Decimal("218.93179")),               # null key never matches
         (4, "Dup Artist", "Same", Decimal("200"))],              # two catalog songs
        "id long, artist string, song string, length decimal(28,10)")
    got = {r.id: (r.song_id, r.artist_id) for r in lookup_song_artist(plays, catalog_df).collect()}
    assert got == {1: ("SOA", "AR1"), 2: (None, None), 3: (None, None), 4: ("SOC", "AR3")}
    assert lookup_song_artist(plays, catalog_df).count() == plays.count()   # no row growth


def test_lookup_point_named_parameters(spark, catalog_df):
    r = lookup_point(catalog_df, "Dup Artist", "Same", Decimal("200")).collect()
    assert [tuple(x) for x in r] == [("SOC", "AR3")]
    assert lookup_point(catalog_df, "Nobody", "Same", Decimal("200")).count() == 0


def _users(spark, rows):
    return spark.createDataFrame(rows, USERS)


def test_upsert_updates_level_only(spark):
    target = _users(spark, [(1, "Ann", "Lee", "F", "free")])
    batch = spark.createDataFrame(
        [(1, "Ann", "Lee", "F", "free", 1), (1, "Changed", "Lee", "F", "paid1", 2),
         (1, "Ann", "Lee", "F", "paid2", 3), (2, "New", "User", "M", "free", 1),
         (2, "Renamed", "User", "M", "paid", 2)],
        "user_id int, first_name string, last_name string, gender string, level string, seq int")
    got = {r.user_id: tuple(r) for r in dml.upsert(target, batch, "user_id", ["level"], ["seq"]).collect()}
    assert got == {1: (1, "Ann", "Lee", "F", "paid2"), 2: (2, "New", "User", "M", "paid")}
    ins = {r.user_id: tuple(r) for r in dml.insert_if_absent(target, batch, "user_id", ["seq"]).collect()}
    assert ins == {1: (1, "Ann", "Lee", "F", "free"), 2: (2, "New", "User", "M", "free")}


def test_delete_by_key_keeps_null_keys(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "user_id int, v string")
    assert sorted(map(tuple, dml.delete_by_key(target, "user_id", 1).collect()), key=str) == \
        sorted([(2, "b"), (None, "c")], key=str)
    keys = spark.createDataFrame([(2,), (None,)], "k int")
    assert sorted(map(tuple, dml.delete_by_key(target, "user_id", keys).collect()), key=str) == \
        sorted([(1, "a"), (None, "c")], key=str)


def test_table_insert_upsert_and_swap(spark):
    name = catalog.fresh_table_name("t_users")
    writers.create_table(spark, name, USERS, scratch_path(spark, "t_users"))
    writers.insert_rows(spark, name, _users(spark, [(1, "Ann", "Lee", "F", "free")]))
    writers.insert_rows(spark, name, _users(spark, [(2, "Bob", "Ray", "M", "free"),
                                                    (3, "Cy", "Di", "M", "paid")]))
    assert spark.table(name).count() == 3
    batch = spark.createDataFrame([(1, "X", "Y", "F", "paid", 1)],
                                  "user_id int, first_name string, last_name string, gender string,"
                                  " level string, seq int")
    dml.replace_contents(spark, name, dml.upsert(spark.table(name), batch, "user_id", ["level"], ["seq"]))
    dml.replace_contents(spark, name, dml.delete_by_key(spark.table(name), "user_id", 3))
    got = {r.user_id: (r.first_name, r.level) for r in spark.table(name).collect()}
    assert got == {1: ("Ann", "paid"), 2: ("Bob", "free")}
    more = spark.createDataFrame([(2, "Zed", "Q", "M", "paid", 1), (4, "Dee", "R", "F", "free", 2),
                                  (4, "Later", "R", "F", "paid", 3)],
                                 "user_id int, first_name string, last_name string, gender string,"
                                 " level string, seq int")
    dml.append_if_absent(spark, name, more, "user_id", ["seq"])
    got = {r.user_id: (r.first_name, r.level) for r in spark.table(name).collect()}
    assert got == {1: ("Ann", "paid"), 2: ("Bob", "free"), 4: ("Dee", "free")}


def test_rows_without_key_all_survive(spark):
    target = _users(spark, [(1, "Ann", "Lee", "F", "free")])
    batch = spark.createDataFrame([(None, "A", "B", "F", "x", 1), (None, "C", "D", "M", "y", 2), (1, "Q", "R", "F", "paid", 3)],
                                  "user_id int, first_name string, last_name string, gender string, level string, seq int")
    for got in (dml.upsert(target, batch, "user_id", ["level"], ["seq"]),
                dml.insert_if_absent(target, batch, "user_id", ["seq"])):
        rows = [tuple(r) for r in got.filter("user_id is null").orderBy("level").collect()]
        assert rows == [(None, "A", "B", "F", "x"), (None, "C", "D", "M", "y")]


def _stored_users(spark, users, layout):
    """A catalog table of users, bucketed by id, partitioned by gender, or plain."""
    from playstats.plans import catalog
    from playstats.scratch import scratch_path
    from playstats.sinks import writers

    name, path = catalog.fresh_table_name(f"users_{layout}"), scratch_path(spark, f"users-{layout}")
    if layout == "bucketed":
        return writers.save_bucketed_table(users, name, "user_id", 8, path)
    writer = users.write.format("parquet").option("path", path)
    (writer.partitionBy("gender") if layout == "partitioned" else writer).saveAsTable(name)
    return name


@pytest.mark.parametrize("layout", ["plain", "partitioned", "bucketed"])
def test_replace_contents_keeps_the_layout(spark, layout):

    users = _users(spark, [(i, f"n{i}", None, "FM"[i % 2], "free") for i in range(40)])
    name = _stored_users(spark, users, layout)
    before = dml.table_layout(spark, name)
    dml.replace_contents(spark, name, dml.delete_by_key(spark.table(name), "user_id",
                                                        spark.createDataFrame([(i,) for i in range(35)], "k int")))
    assert sorted(r.user_id for r in spark.table(name).collect()) == [35, 36, 37, 38, 39]
    assert spark.table(name).filter("gender = 'F'").count() == 2
    assert dml.table_layout(spark, name) == before
    other = _stored_users(spark, users, layout)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = spark.table(name).join(spark.table(other).select("user_id", "level"), "user_id")
        assert j.count() == 5
        if layout == "bucketed":
            assert "Exchange" not in j._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_catalog_reset_and_listing(spark):
    db = catalog.fresh_table_name("wh")
    assert catalog.reset_warehouse(spark, db, scratch_path(spark, db))
    assert db in [r.database for r in catalog.list_databases(spark).collect()]
    names = [r.table_name for r in catalog.list_tables(spark, db).collect()]
    assert names == ["artists", "songplays", "songs", "times", "users"]
    assert catalog.reset_warehouse(spark, db, scratch_path(spark, db))   # rerun is fine
    with pytest.raises(TypeError):
        catalog.run_statements(spark, "SELECT 1")
    with pytest.raises(Exception):
        catalog.run_statements(spark, ["SELECT 1", "SELECT * FROM no_such_table", "SELECT 2"])
