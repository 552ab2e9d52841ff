"""Batches checked by key filters."""

import random

import pytest

from playstats.operators.quality import QualityError
from playstats.sinks import constraints
from playstats.sinks.versioned import Layout, VersionedTables

USERS = "user_id int, name string, level string"


@pytest.fixture()
def store(spark, tmp_path):
    s = VersionedTables(spark, str(tmp_path / "t"))
    users = [(i * 3, f"n{i}", "free") for i in range(300)] + [(None, "x", "free")]
    s.publish({"users": spark.createDataFrame(users, USERS), "none": spark.createDataFrame([], USERS)},
              {"users": Layout("user_id", 16, filters=True), "none": Layout("user_id", 4, filters=True)})
    return s


def keys(spark, *ids):
    return spark.createDataFrame([(i, "a", "b") for i in ids], "user_id bigint, name string, level string")


def held(store, df):
    return sorted(r.key for r in constraints.stored_keys(store, "users", df.select("user_id")).collect())


def test_stored_keys_are_found_exactly(spark, store):
    rng = random.Random(1)
    ids = [rng.randrange(1000) for _ in range(200)]
    assert held(store, keys(spark, *ids, None)) == sorted({i for i in ids if i % 3 == 0 and i < 900})
    assert constraints.stored_keys(store, "none", keys(spark, 1, 2).select("user_id")).collect() == []


def test_filters_follow_every_change(spark, store):
    store.delete("users", spark.createDataFrame([(3,), (6,)], "k int"))
    batch = spark.createDataFrame([(1000, "n", "l", 1), (9, "n", "l", 1), (None, "n", "l", 1)], USERS + ", seq int")
    store.upsert("users", batch, ["level"], ["seq"])
    stage = store.stage()
    stage.insert_if_absent("users", spark.createDataFrame([(2000, "n", "l"), (9, "n", "l")], USERS), ["name"])
    stage.commit()
    probe = keys(spark, 0, 1, 3, 6, 9, 1000, 2000, 3000)
    assert held(store, probe) == [0, 9, 1000, 2000]                       # a deleted key passes its filter, not the look
    store.compact("users")
    assert held(store, probe) == [0, 9, 1000, 2000]
    entry = store.manifest()["users"]
    assert all(len(p) == 1 for p in entry["filters"].values())
    assert store.vacuum(keep=1, older_than_hours=0) and held(store, probe) == [0, 9, 1000, 2000]


def test_buckets_without_a_hit_are_not_opened(spark, store, monkeypatch):
    opened, real = [], VersionedTables._rows
    monkeypatch.setattr(VersionedTables, "_rows", lambda self, e, b=None, places=False: (opened.append(b), real(self, e, b, places))[1])
    assert held(store, keys(spark, 100_001, 100_003, 100_007)) == []
    touched = {b for bs in opened for b in bs}
    assert len(touched) <= 1                                              # at most a false alarm
    opened.clear()
    assert held(store, keys(spark, 3)) == [3] and len(opened) == 1 and len(opened[0]) == 1


def test_batches_are_refused(spark, store):
    constraints.assert_batch(store, "users", keys(spark, 1, 2, 4))
    for bad in ((1, 1), (None,), (3,)):
        with pytest.raises(QualityError):
            constraints.assert_batch(store, "users", keys(spark, *bad))
    got = {r.key: r.n_rows for r in constraints.batch_key_violations(store, "users", keys(spark, 1, 1, 3, 3, 6, 7, None)).collect()}
    assert got == {1: 2, 3: 2, 6: 1, None: 1}
    plays = spark.createDataFrame([(1, 0), (2, 0), (3, 4), (4, 5), (5, 5), (6, None)], "id int, user int")
    bad = constraints.batch_reference_violations(store, "users", plays, "user")
    assert sorted(map(tuple, bad.collect())) == [(4, 1), (5, 2)]
    with pytest.raises(QualityError, match="users"):
        constraints.assert_batch(store, "users", keys(spark, 1).selectExpr("*", "5 as friend"), {"friend": "users"})
    with pytest.raises(ValueError):
        store.publish({"plain": plays}, {"plain": Layout("id", 2)})
        constraints.stored_keys(store, "plain", plays.select("id"))
