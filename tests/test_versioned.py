"""Versions: whole-load publish, pruned upsert, delete vectors, compaction, vacuum."""

import os
import random

import pytest
from pyspark.sql import functions as F

from playstats.operators.quality import QualityError
from playstats.plans import star
from playstats.sinks import dml
from playstats.sinks.versioned import BUCKET, Layout, VersionedTables
from playstats.storage import CommitLog, ConcurrentCommit

USERS = "user_id int, name string, level string"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def files(store):
    """Data file -> (size, time) below the store."""
    found = {}
    for folder, _, names in os.walk(f"{store.root}/data"):
        for n in names:
            if n.endswith(".parquet"):
                st = os.stat(f"{folder}/{n}")
                found[f"{folder}/{n}"] = (st.st_size, st.st_mtime_ns)
    return found


@pytest.fixture()
def store(spark, tmp_path):
    s = VersionedTables(spark, str(tmp_path / "tables"))
    users = [(i, f"n{i}", "free") for i in range(200)] + [(None, "nobody", "free"), (None, "nobody", "free")]
    s.publish({"users": spark.createDataFrame(users, USERS)}, {"users": Layout("user_id", 16)})
    return s


def buckets_of(spark, store, ids):
    return set(store.stage()._buckets_of("users", spark.createDataFrame([(i,) for i in ids], "user_id int")))


def test_upsert_rewrites_only_buckets_with_batch_keys(spark, store):
    before, old = files(store), store.read("users")
    expected_old = rows(old)
    batch = spark.createDataFrame([(3, "x", "paid", 1), (3, "y", "gold", 2), (500, "new", "free", 1), (None, "z", "paid", 1)],
                                  USERS + ", seq int")
    expected = rows(dml.upsert(old, batch, "user_id", ["level"], ["seq"]))
    assert store.upsert("users", batch, ["level"], ["seq"]) == 2
    assert rows(store.read("users")) == expected
    after = files(store)
    assert {f: after[f] for f in before} == before                       # no file changed its name, size or time
    touched = buckets_of(spark, store, [3, 500])
    new = {f.split(f"{BUCKET}=")[1].split("/")[0] for f in set(after) - set(before) if "users-more" not in f}
    assert new == touched and len(touched) < 16
    assert rows(store.read("users", version=1)) == expected_old          # the old version is still there


def test_upsert_reads_only_touched_buckets(spark, store):
    entry = store.manifest()["users"]
    plan = store._rows(entry, sorted(buckets_of(spark, store, [3])))
    assert len(plan.inputFiles()) == 1


def test_delete_writes_one_row_per_deleted_row(spark, store):
    before = files(store)
    keys = spark.createDataFrame([(5,), (5,), (7,), (None,), (9999,)], "k bigint")
    expected = rows(dml.delete_by_key(store.read("users"), "user_id", keys))
    assert store.delete("users", keys) == 2
    assert rows(store.read("users")) == expected and len(expected) == 200
    new = set(files(store)) - set(before)
    assert sum(spark.read.parquet(f).count() for f in new) == 2           # two places, no table rows
    assert store.delete("users", 5) == 2                                 # nothing left to delete: no new version
    assert store.delete("users", 8) == 3
    assert rows(store.read("users")) == [r for r in expected if r[0] != 8]
    # compaction: the same rows, no vector, other buckets untouched
    mid = files(store)
    assert store.compact("users") == 4
    assert store.manifest()["users"]["deletes"] == {}
    assert rows(store.read("users")) == [r for r in expected if r[0] != 8]
    assert {f: s for f, s in files(store).items() if f in mid} == mid
    assert store.compact("users") == 4


def test_upsert_and_delete_in_turns_equal_the_pure_functions(spark, store):
    rng = random.Random(1)
    plain = store.read("users")
    want = rows(plain)
    for turn in range(4):
        ids = [rng.randrange(260) for _ in range(30)]
        have = spark.createDataFrame(want, USERS)
        if turn % 2:
            keys = spark.createDataFrame([(i,) for i in ids], "k int")
            want = rows(dml.delete_by_key(have, "user_id", keys))
            store.delete("users", keys)
        else:
            batch = spark.createDataFrame([(i, f"b{n}", f"l{n}", n) for n, i in enumerate(ids)], USERS + ", seq int")
            want = rows(dml.upsert(have, batch, "user_id", ["level"], ["seq"]))
            store.upsert("users", batch, ["level"], ["seq"])
        assert rows(store.read("users")) == want


def test_hot_missing_key_is_spread(spark, tmp_path):
    s = VersionedTables(spark, str(tmp_path / "t"))
    s.publish({"u": spark.createDataFrame([(None, f"n{i}", "x") for i in range(400)], USERS)}, {"u": Layout("user_id", 8)})
    counts = [spark.read.parquet(s._path(p[0])).count() for p in s.manifest()["u"]["parts"].values()]
    assert len(counts) == 8 and max(counts) < 100


def test_failing_check_publishes_nothing(spark, store):
    kept = files(store)

    def refuse(tables):
        assert tables["users"].count() == 1                              # it sees the new contents
        raise QualityError("no")

    with pytest.raises(QualityError):
        store.publish({"users": spark.createDataFrame([(1, "a", "b")], USERS)}, check=refuse)
    with pytest.raises(QualityError):
        store.upsert("users", spark.createDataFrame([(1, "a", "b", 1)], USERS + ", seq int"), ["level"], ["seq"],
                     check=lambda t: (_ for _ in ()).throw(QualityError("no")))
    assert store.version() == 1 and store.read("users").count() == 202 and files(store) == kept


def test_two_writers_of_one_version(spark, store):
    a, b = store.stage(), store.stage()
    for n, stage in enumerate((a, b)):
        stage.write("users", spark.createDataFrame([(n, "a", "b")], USERS))
    assert a.commit() == 2
    with pytest.raises(ConcurrentCommit):
        b.commit()
    assert [r.user_id for r in store.read("users").collect()] == [0]


def test_empty_table_and_unknown_names(spark, store):
    store.publish({"none": spark.createDataFrame([], USERS)}, {"none": Layout("user_id", 4)})
    assert store.delete("none", 1) == store.compact("none") == 2
    assert store.read("none").collect() == [] and store.names() == ["none", "users"]
    assert store.delete("none", 1) == store.version()
    store.upsert("none", spark.createDataFrame([(1, "a", "b", 1)], USERS + ", seq int"), ["level"], ["seq"])
    assert rows(store.read("none")) == [(1, "a", "b")]
    with pytest.raises(KeyError):
        store.upsert("other", spark.range(1), [], [])


def test_appends_to_partition_folders_and_compaction(spark, tmp_path):
    s = VersionedTables(spark, str(tmp_path / "t"))
    parts = [spark.createDataFrame([(n, f"n{n}", f"l{n % 2}")], USERS) for n in range(3)]
    s.publish({"u": parts[0]}, {"u": Layout(partition_by=("level",))})
    for part in parts[1:]:
        stage = s.stage()
        stage.append("u", part)
        stage.commit()
    want = [(n, f"n{n}", f"l{n % 2}") for n in range(3)]
    assert rows(s.read("u")) == want and len(s.manifest()["u"]["parts"][""]) == 3
    s.compact("u")
    assert rows(s.read("u")) == want and len(s.manifest()["u"]["parts"][""]) == 1
    assert s.read("u").filter("level = 'l0'").count() == 2


def test_vacuum_keeps_what_versions_name(spark, store):
    for n in range(3):
        store.delete("users", n)
    orphan = store.stage()
    orphan.write("users", spark.createDataFrame([(1, "a", "b")], USERS))   # a run that died
    want = rows(store.read("users"))
    assert store.vacuum(keep=1, older_than_hours=1) == []                 # all too young
    assert len(store.vacuum(keep=1, older_than_hours=0)) == 1             # the orphan; the rest is in use
    assert rows(store.read("users")) == want and store.log.numbers() == [4]
    store.compact("users")
    assert store.vacuum(keep=1, older_than_hours=0) != [] and rows(store.read("users")) == want


def test_log_numbers_are_given_once(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"))
    assert log.last() == (0, {})
    log.add(1, {"a": "é"})
    with pytest.raises(ConcurrentCommit):
        log.add(1, {"a": 2})
    assert log.last() == (1, {"a": "é"})
    assert [n for n in os.listdir(tmp_path / "log") if n.startswith(".draft")] == []


# ------------------------------------------------------------ the whole load

def test_a_load_that_fails_its_check_leaves_the_last_one(spark, song_tree, log_tree, tmp_path):
    from tests.conftest import song, write_lines

    out = str(tmp_path / "out")
    first = {n: rows(t) for n, t in star.run_pipeline(spark, song_tree, log_tree, out).items()}
    write_lines(str(tmp_path / "songs" / "a.json"), [song("S1", "t", "AR1", 1, 1.0, "One"), song("S1", "u", "AR1", 1, 1.0, "One")])
    with pytest.raises(QualityError):  # two rows of one id: found on the written table
        star.run_pipeline(spark, str(tmp_path / "songs"), log_tree, out, on_conflict="keep_all")
    store = VersionedTables(spark, out)
    assert store.version() == 1 and {n: rows(t) for n, t in store.tables().items()} == first
    assert len(os.listdir(f"{out}/data")) == 1


@pytest.mark.parametrize("catalog_tables", [False, True])
def test_a_crash_between_tables_leaves_the_last_load(spark, song_tree, log_tree, tmp_path, monkeypatch, catalog_tables):
    from playstats.plans import catalog

    db = catalog.fresh_table_name("crash") if catalog_tables else None
    kw = {"database": db, "buckets": 4} if db else {}
    out = str(tmp_path / "out")
    first = {n: rows(t) for n, t in star.run_pipeline(spark, song_tree, log_tree, out, **kw).items()}

    def dies(plays):
        raise OSError("lost")

    monkeypatch.setattr(star, "build_users", dies)  # artists, songs and times are written by then
    with pytest.raises(OSError):
        star.run_pipeline(spark, song_tree, log_tree, out, **kw)
    monkeypatch.undo()
    store = VersionedTables(spark, out)
    assert {n: rows(t) for n, t in store.tables().items()} == first
    if db:
        assert {n: rows(spark.table(f"{db}.{n}")) for n in first} == first
        star.run_pipeline(spark, song_tree, log_tree, out, **kw)
        star.run_pipeline(spark, song_tree, log_tree, out, **kw)
        names = [t.name for t in spark.catalog.listTables(db)]
        assert len([n for n in names if n.startswith("songplays__")]) == 2 and "songplays" in names
        assert rows(spark.table(f"{db}.songplays")) == first["songplays"]


def test_views_follow_the_published_version(spark, song_tree, log_tree, tmp_path, monkeypatch):
    from playstats.plans import catalog

    db, out = catalog.fresh_table_name("views"), str(tmp_path / "out")
    catalog.reset_warehouse(spark, db, str(tmp_path / "wh"))             # five empty tables are in the way
    spark.range(1).createOrReplaceTempView("songs")                       # and so is a view of the session
    star.run_pipeline(spark, song_tree, log_tree, out, database=db)
    monkeypatch.setattr(star, "point_views", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):  # dies between commit and views
        star.run_pipeline(spark, song_tree, log_tree, out, database=db)
    monkeypatch.undo()
    star.point_views(spark, out, db)
    store = VersionedTables(spark, out)
    assert store.version() == 2
    for n in store.names():
        assert rows(spark.table(f"{db}.{n}")) == rows(store.read(n))
        assert store.manifest()[n]["parts"][""][0].split("/")[1] in spark.table(f"{db}.{n}").inputFiles()[0]
    spark.catalog.dropTempView("songs")
