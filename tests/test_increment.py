"""File ledger, continued ids and loads that read only new files."""

import os
import time

import pytest

from playstats.operators.sequence import Sequence
from playstats.plans import increment, star
from playstats.sinks.versioned import VersionedTables
from playstats.sources.ledger import FileLedger, list_tree
from playstats.storage import ConcurrentCommit
from tests.conftest import play, song, write_lines

DAY = 1541121934796


def rows(df, *without):
    return sorted(map(tuple, df.drop(*without).collect()), key=repr)


def names(pending):
    return sorted(os.path.basename(r.file_path) for r in pending.files().collect())


# ------------------------------------------------------------ ledger

def test_ledger_gives_new_and_changed_files_once(spark, tmp_path):
    root, ledger = tmp_path / "src", FileLedger(spark, str(tmp_path / "notes"))
    for n in ("top.json", "a/x.json", "a/deep/y.json", "b/z.json", "b/note.txt", ".hidden/h.json"):
        write_lines(str(root / n), [{"n": n}])
    write_lines(str(root / "odd [1]{2}*?.json"), [{"n": "odd"}])
    first = ledger.pending(str(root))
    assert names(first) == ["odd [1]{2}*?.json", "top.json", "x.json", "y.json", "z.json"]
    again = ledger.pending(str(root))                                     # not committed: still pending
    assert names(again) == names(first)
    values = sorted(r.value for r in first.read(lambda paths: spark.read.text(paths), most=2).collect())
    assert len(values) == 5 and '{"n": "odd"}' in values
    first.commit()
    with pytest.raises(ConcurrentCommit):                                 # listed the same state
        again.commit()
    assert ledger.pending(str(root)).is_empty()
    time.sleep(0.01)
    write_lines(str(root / "a/x.json"), [{"n": "changed, longer"}])
    write_lines(str(root / "c/new.json"), [{"n": 1}])
    second = ledger.pending(str(root))
    assert names(second) == ["new.json", "x.json"]
    second.commit()
    assert ledger.pending(str(root)).is_empty() and ledger.loaded().count() == 6


def test_listing_goes_by_top_folder(spark, tmp_path):
    for n in ("top.json", "a/x.json", "a/deep/y.json", "b/z.json"):
        write_lines(str(tmp_path / n), [{}])
    assert [f.count() for f in list_tree(spark, str(tmp_path))] == [1, 2, 1]
    with pytest.raises(FileNotFoundError):
        list(list_tree(spark, str(tmp_path / "absent")))


def test_empty_source(spark, tmp_path):
    os.makedirs(tmp_path / "src")
    pending = FileLedger(spark, str(tmp_path / "notes")).pending(str(tmp_path / "src"))
    assert pending.is_empty() and pending.read(spark.read.text) is None
    pending.commit()
    assert os.listdir(tmp_path / "notes") == []


# ------------------------------------------------------------ sequence

def test_sequence_goes_on_and_repeats_a_batch(spark, tmp_path):
    ids = Sequence(spark, str(tmp_path), "play", first=5)
    df = spark.createDataFrame([(k,) for k in (3, 1, 2)], "k int")
    assert rows(ids.number(df, ["k"], "one", "id")) == [(1, 5), (2, 6), (3, 7)]
    assert ids.next_value() == 8
    other = Sequence(spark, str(tmp_path), "play")                        # another session, the same store
    assert rows(other.number(df, ["k"], "two", "id")) == [(1, 8), (2, 9), (3, 10)]
    assert rows(other.number(df, ["k"], "one", "id")) == [(1, 5), (2, 6), (3, 7)]
    assert other.next_value() == 11 and other.reserve("none", 0) == 11
    with pytest.raises(ValueError):
        other.number(df.limit(1), ["k"], "one", "id")


def test_two_loads_at_a_time_get_different_blocks(spark, tmp_path, monkeypatch):
    ids = Sequence(spark, str(tmp_path), "play")
    real, raced = ids.blocks.last, []

    def last():  # between look and reservation another load reserves
        seen = real()
        if not raced:
            raced.append(Sequence(spark, str(tmp_path), "play").reserve("other", 4))
        return seen

    monkeypatch.setattr(ids.blocks, "last", last)
    assert ids.reserve("mine", 3) == 4 and raced == [0]


# ------------------------------------------------------------ incremental load

def deliver(tmp_path, name, plays):
    write_lines(str(tmp_path / "logs" / name / "p.json"), plays)


def plain(tables):
    """The tables without the numbers that depend on the order of the loads."""
    return {"songs": rows(tables["songs"]), "artists": rows(tables["artists"]), "users": rows(tables["users"]),
            "times": rows(tables["times"].select("start_time", "hour", "day", "week", "month", "year", "weekday")),
            "songplays": rows(tables["songplays"], "songplay_id", "time_id")}


def test_increments_equal_one_load(spark, tmp_path):
    songs, logs, out = str(tmp_path / "songs"), str(tmp_path / "logs"), str(tmp_path / "out")
    write_lines(f"{songs}/a/1.json", [song("SOA", "Song A", "AR1", 2001, 218.93179, "Artist One")])
    ann = dict(first="Ann", last="Lee", gender="F")
    deliver(tmp_path, "d1", [play(DAY + 5000, "88", level="paid", **ann, artist="Artist One", song_="Song A", length=218.93179),
                             play(DAY + 9000, "12", "Bob", None, "M", "free")])
    one = increment.run_increment(spark, songs, logs, out, buckets=4)
    assert sorted(r.songplay_id for r in one["songplays"].collect()) == [0, 1]
    assert VersionedTables(spark, out).version() == 1
    # nothing new: nothing is published or written
    increment.run_increment(spark, songs, logs, out, buckets=4)
    assert VersionedTables(spark, out).version() == 1
    # an older play of Ann, a line that came before, a new song and its play
    write_lines(f"{songs}/b/2.json", [song("SOB", "Song B", "AR2", 2002, 10.0, "Artist Two"),
                                      song("SOA", "Song A", "AR1", 2001, 218.93179, "Artist One")])
    deliver(tmp_path, "d2", [play(DAY, "88", level="free", **ann), play(DAY + 9000, "12", "Bob", None, "M", "free"),
                             play(DAY + 20_000, "12", "Bob", None, "M", "paid", "Artist Two", "Song B", 10.0),
                             play(DAY + 20_000, "12", "Bob", None, "M", "paid", "Artist Two", "Song B", 10.0, item=1)])
    two = increment.run_increment(spark, songs, logs, out, buckets=4)
    assert sorted(r.songplay_id for r in two["songplays"].collect()) == [0, 1, 2, 3, 4]
    assert {r.user_id: r.level for r in two["users"].collect()} == {88: "paid", 12: "paid"}
    whole = star.run_pipeline(spark, songs, logs, str(tmp_path / "whole"))
    assert plain(two) == plain(whole)
    assert rows(two["times"].select("time_id")) == rows(two["songplays"].select("songplay_id"))


def test_a_run_that_dies_before_its_notes_loads_nothing_twice(spark, tmp_path, monkeypatch):
    songs, logs, out = str(tmp_path / "songs"), str(tmp_path / "logs"), str(tmp_path / "out")
    write_lines(f"{songs}/1.json", [song("SOA", "Song A", "AR1", 2001, 1.0, "Artist One")])
    deliver(tmp_path, "d1", [play(DAY + k, "88", "Ann", "Lee", "F", "free", item=k) for k in range(5)])
    with monkeypatch.context() as m:
        m.setattr(star, "build_songplays", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            increment.run_increment(spark, songs, logs, out, buckets=4)
    assert VersionedTables(spark, out).version() == 0 and os.listdir(f"{out}/data") == []
    with monkeypatch.context() as m:
        m.setattr(increment.PendingFiles, "commit", lambda self: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            increment.run_increment(spark, songs, logs, out, buckets=4)
    before = plain(VersionedTables(spark, out).tables())
    after = increment.run_increment(spark, songs, logs, out, buckets=4)
    assert plain(after) == before and after["songplays"].count() == 5
    assert VersionedTables(spark, out).version() == 1                     # all lines were there
    # the failed run had reserved the block for the same files: no gap
    assert sorted(r.songplay_id for r in after["songplays"].collect()) == [0, 1, 2, 3, 4]


def test_first_load_without_any_file(spark, tmp_path):
    os.makedirs(tmp_path / "songs")
    os.makedirs(tmp_path / "logs")
    tables = increment.run_increment(spark, str(tmp_path / "songs"), str(tmp_path / "logs"), str(tmp_path / "out"), buckets=4)
    assert {n: t.count() for n, t in tables.items()} == dict.fromkeys(("songs", "artists", "users", "times", "songplays"), 0)
    deliver(tmp_path, "d1", [play(DAY, "88", "Ann", "Lee", "F", "free")])
    tables = increment.run_increment(spark, str(tmp_path / "songs"), str(tmp_path / "logs"), str(tmp_path / "out"), buckets=4)
    assert tables["songplays"].count() == tables["times"].count() == tables["users"].count() == 1


def test_a_load_writes_its_plays_once(spark, tmp_path, monkeypatch):
    labels = []

    def noted(df, label, write=increment.stored):
        labels.append(label)
        return write(df, label)

    monkeypatch.setattr(increment, "stored", noted)
    monkeypatch.setattr(star, "stored", noted)
    songs, logs, out = (str(tmp_path / x) for x in ("songs", "logs", "out"))
    write_lines(f"{songs}/a/1.json", [song("SOA", "Song A", "AR1", 2001, 218.93179, "Artist One")])
    line = play(DAY, "12", "Bob", None, "M", "free")
    deliver(tmp_path, "d1", [line, line, play(DAY + 1000, "12", "Bob", None, "M", "paid")])
    increment.run_increment(spark, songs, logs, out, buckets=4)
    deliver(tmp_path, "d2", [line, play(DAY + 9000, "7", "Ann", "Lee", "F", "free")])
    two = increment.run_increment(spark, songs, logs, out, buckets=4)
    assert two["songplays"].count() == two["times"].count() == 3
    # the new lines are distinct: no second distinct; facts and times go straight to their tables
    assert labels.count("new-lines") == 2
    assert not {"distinct-plays", "new-times", "new-songplays"} & set(labels)
