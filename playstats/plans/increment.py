"""Loads that read only what is new.

:func:`run_increment` loads the song and log files that no earlier run has loaded
(``sources.ledger``) and publishes the next version of the star tables
(``sinks.versioned``): plays and times get folders of their own with ids that go on
behind the last load (``operators.sequence``), new songs and artists are added, and
users take over what a play later than their last one says. Work and writes are in
proportion to the new files, except that the digests of the loaded lines (16 bytes
each) are read to leave out lines that came before.

A run that dies leaves the last version in force. If it dies between publishing and
noting its files, the next run reads them again and finds all their lines loaded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playstats.operators.keys import keep_last
from playstats.operators.lookup import song_artist_catalog
from playstats.operators.quality import assert_not_null, assert_primary_key, assert_row_counts_equal
from playstats.operators.sequence import Sequence
from playstats.plans import star
from playstats.schemas import LOG_SCHEMA, NOT_NULL, PRIMARY_KEYS, SONG_SCHEMA
from playstats.scratch import stored
from playstats.sinks.versioned import Layout, Stage, VersionedTables
from playstats.sources.files import read_json_lines
from playstats.sources.ledger import FileLedger, PendingFiles

#: Buckets of the tables that are changed by key, for a table of some GB.
BUCKETS = 64

#: Digests of the loaded log lines, and the event time of each user's last play.
LINES, MARKS = "loaded_lines", "user_marks"


def _lines(spark: SparkSession, pending: PendingFiles, schema) -> DataFrame | None:
    return pending.read(lambda paths: read_json_lines(spark, paths, schema, distinct=False, keep_extra=True))


def _batch_name(version: int, pending: PendingFiles) -> str:
    """The same for every run over the same state of the same files and tables."""
    facts = pending.files().agg(F.count("*"), F.bit_xor(F.xxhash64("file_path", "file_bytes", "modified"))).first()
    return f"{version}-{facts[0]}-{facts[1]}"


def _new_lines(raw: DataFrame, store: VersionedTables) -> DataFrame:
    """The distinct plays that no earlier run has loaded, with their digest."""
    columns = [F.col(f"`{c}`").cast("string") for c in raw.columns if c != "_extra"] + [F.to_json("_extra")]
    # NULL, an empty text and the border between two columns are told apart
    parts = [F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in columns]
    lines = (raw.filter(F.col("page") == star.NEXT_SONG)
             .withColumn("_digest", F.unhex(F.md5(F.concat_ws("|", *parts)))).dropDuplicates(["_digest"]))
    if LINES in store.names():
        lines = lines.join(store.read(LINES).select("_digest"), "_digest", "left_anti")
    return stored(lines, "new-lines")


def _add(stage: Stage, name: str, df: DataFrame, layout: Layout = Layout()) -> DataFrame:
    """Writes the rows of a table without buckets to the stage; the rows as written."""
    if name in stage.manifest:
        stage.append(name, df)
        written = stage.path(f"{name}-more")
    else:
        stage.write(name, df, layout)
        written = stage.path(name)
    return stage.store.spark.read.schema(df.schema).parquet(written)


def _add_dimension(stage: Stage, name: str, rows: DataFrame, key: str, buckets: int) -> None:
    """A key that is stored keeps its row; of several new rows of a key the smallest is taken."""
    if name in stage.manifest:
        stage.insert_if_absent(name, rows, [c for c in rows.columns if c != key])
    else:
        stage.write(name, star.split_conflicts(rows, key)[0], Layout(key, buckets))


def _change_users(stage: Stage, plays: DataFrame, buckets: int) -> None:
    """Each user as of the last play by event time, whatever the order of the loads."""
    last = keep_last(plays.filter(F.col("userId").isNotNull())
                     .select(F.col("userId").alias("user_id"), F.col("firstName").alias("first_name"),
                             F.col("lastName").alias("last_name"), "gender", "level", "ts", "songplay_id"),
                     ["user_id"], ["ts", "songplay_id"])
    last = stored(last.select("user_id", "first_name", "last_name", "gender", "level", "ts"), "last-plays")
    users, marks = last.drop("ts"), last.select("user_id", "ts")
    if "users" not in stage.manifest:
        stage.write("users", users, Layout("user_id", buckets))
        stage.write(MARKS, marks, Layout("user_id", buckets))
        return
    old = stage.store.read(MARKS).select("user_id", F.col("ts").alias("_old"))
    newer = stored(last.join(old, "user_id", "left").filter("_old IS NULL OR ts >= _old").drop("_old"), "newer-users")
    stage.upsert("users", newer, ["first_name", "last_name", "gender", "level"], ["ts"])
    stage.upsert(MARKS, newer.select("user_id", "ts"), ["ts"], ["ts"])


def run_increment(spark: SparkSession, song_dir: str, log_dir: str, out_dir: str,
                  check: bool = True, buckets: int = BUCKETS) -> dict[str, DataFrame]:
    """Loads the new and changed files of both folders into ``out_dir`` and returns the
    five tables. Without new files nothing is read or published. ``check``: the new rows
    meet the constraints (their keys are new by the way they are given). ``buckets``: of
    the tables that are changed by key, when they are first written."""
    out = out_dir.rstrip("/")
    store = VersionedTables(spark, out)
    songs_files = FileLedger(spark, f"{out}/_ledger/songs").pending(song_dir)
    log_files = FileLedger(spark, f"{out}/_ledger/logs").pending(log_dir)
    song_raw, log_raw = _lines(spark, songs_files, SONG_SCHEMA), _lines(spark, log_files, LOG_SCHEMA)
    stage = store.stage()
    new: dict[str, DataFrame] = {}
    try:
        if song_raw is not None or not stage.manifest:
            song_raw = song_raw if song_raw is not None else spark.createDataFrame([], SONG_SCHEMA)
            song_raw = stored(song_raw.select(*SONG_SCHEMA.names).dropDuplicates(), "new-songs")
            _add_dimension(stage, "artists", star.all_artists(song_raw), "artist_id", buckets)
            _add_dimension(stage, "songs", star.all_songs(song_raw), "song_id", buckets)
        lines = _new_lines(log_raw, store) if log_raw is not None else None
        if "songplays" not in stage.manifest or (lines is not None and not lines.isEmpty()):
            plays = _numbered(spark, out, lines, _batch_name(stage.base, log_files))
            if lines is not None:
                _add(stage, LINES, lines.select("_digest"))
            new = {"times": _add(stage, "times", star.build_times(plays), Layout(partition_by=("year", "month"))),
                   "songplays": _add(stage, "songplays", star.build_songplays(plays, _catalog(stage)))}
            _change_users(stage, plays, buckets)
        if check:
            for name, df in new.items():
                assert_primary_key(df, PRIMARY_KEYS[name], name)
                assert_not_null(df, NOT_NULL.get(name, []), name)
            if new:
                assert_row_counts_equal(new["songplays"], new["times"], "songplays", "times")
    except BaseException:
        stage.discard()
        raise
    stage.commit()
    songs_files.commit()
    log_files.commit()
    return {n: t for n, t in store.tables().items() if n not in (LINES, MARKS)}


def _catalog(stage: Stage) -> DataFrame:
    tables = stage.tables()
    return song_artist_catalog(tables["songs"], tables["artists"])


def _numbered(spark: SparkSession, out: str, lines: DataFrame | None, batch: str) -> DataFrame:
    """The new plays, numbered behind those of the earlier loads."""
    lines = spark.createDataFrame([], LOG_SCHEMA) if lines is None else lines.drop("_digest")
    return Sequence(spark, f"{out}/_sequence", "songplay_id").number_sorted(
        star.ordered_plays(lines, distinct=True), batch, "songplay_id")
