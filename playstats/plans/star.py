"""Star-schema builders: songs, artists, times, users, songplays, and the whole
run from two JSON folders to five Parquet tables.

Order of work: the song side first (the play lookup needs it), then plays.
Log lines are parsed once and made distinct (a repeated line shrinks to one row
per task before the shuffle), stored, then numbered in event-time order
(``songplay_id``) and stored again. Both ``times`` and ``songplays`` derive from
that one numbered table, so ``time_id`` equals ``songplay_id`` in every row and
the two tables are 1:1 by construction.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playstats.functions.cleaning import clean_frame, convert
from playstats.functions.timeparts import epoch_ms_to_start_time, time_part_columns
from playstats.operators.keys import by_range as _by_range
from playstats.operators.keys import keep_first, keep_last, number_sorted_partitions
from playstats.operators.lookup import lookup_song_artist, song_artist_catalog
from playstats.operators.quality import assert_primary_key, assert_row_counts_equal, check_star
from playstats.schemas import LOG_SCHEMA, SONG_SCHEMA
from playstats.scratch import stored
from playstats.sinks.versioned import Layout, Stage, VersionedTables
from playstats.sinks.writers import save_bucketed_table, write_table
from playstats.sources.files import read_json_lines, split_bad

# Fixed value: the log page that records a song play (must equal the source data's).
NEXT_SONG = "NextSong"

SONG_COLUMNS = ["song_id", "title", "artist_id", "year", "duration"]
ARTIST_COLUMNS = {"artist_id": "artist_id", "artist_name": "name", "artist_location": "location",
                  "artist_latitude": "latitude", "artist_longitude": "longitude"}
TIME_COLUMNS = ["start_time", "hour", "day", "week", "month", "year", "weekday"]


def read_song_data(spark: SparkSession, song_dir: str, **kw) -> DataFrame:
    return read_json_lines(spark, song_dir, SONG_SCHEMA, **kw)


def read_log_data(spark: SparkSession, log_dir: str, **kw) -> DataFrame:
    return read_json_lines(spark, log_dir, LOG_SCHEMA, **kw)


def all_songs(song_raw: DataFrame) -> DataFrame:
    """Every distinct song row, cleaned, whether or not its id repeats."""
    return clean_frame(song_raw.select(*SONG_COLUMNS)).dropDuplicates()


def all_artists(song_raw: DataFrame) -> DataFrame:
    """Every distinct artist row (spelling, location), cleaned."""
    return clean_frame(song_raw.select(*[F.col(s).alias(t) for s, t in ARTIST_COLUMNS.items()])).dropDuplicates()


def split_conflicts(rows: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(one row per key, the other rows) of distinct rows: of several rows of one
    key the one with the smallest attribute values is kept, the others are set
    aside."""
    kept = keep_first(rows, [key], [c for c in rows.columns if c != key]).select(*rows.columns)
    return kept, rows.exceptAll(kept)


def _resolve(rows: DataFrame, key: str, policy: str, table: str) -> DataFrame:
    if policy == "error":
        assert_primary_key(rows, [key], table)
        return rows
    if policy == "quarantine":
        return split_conflicts(rows, key)[0]
    if policy == "keep_all":
        return rows
    raise ValueError(f"unknown conflict policy {policy!r}")


def build_songs(song_raw: DataFrame, on_conflict: str = "error") -> DataFrame:
    """One row per song id. Several rows for one id fail by default;
    ``'quarantine'`` keeps one (see :func:`split_conflicts`), ``'keep_all'`` all."""
    return _resolve(all_songs(song_raw), "song_id", on_conflict, "songs")


def build_artists(song_raw: DataFrame, on_conflict: str = "error") -> DataFrame:
    """One row per artist id; one id with two spellings or locations is a key
    conflict, treated as in :func:`build_songs`."""
    return _resolve(all_artists(song_raw), "artist_id", on_conflict, "artists")


def prepare_plays(log_raw: DataFrame, strict_user_id: bool = True,
                  num_partitions: int | None = None) -> DataFrame:
    """NextSong events, de-duplicated and cleaned, with start_time, its parts,
    an integer user_id and a dense ``songplay_id`` in event-time order (ts,
    then the other raw fields as tie-break), stored as Parquet.

    ``log_raw`` may carry ``_extra`` (undeclared fields, from
    ``read_log_data(..., distinct=False, keep_extra=True)``), which then takes
    part in the distinct and the tie-break. An already distinct frame works too.

    A userId that is no number fails the job; with ``strict_user_id=False`` it
    becomes NULL and stays visible in column ``rejected_user_id``
    (:func:`rejected_plays`).
    """
    return number_sorted_partitions(ordered_plays(log_raw, strict_user_id, num_partitions), "songplay_id")


def ordered_plays(log_raw: DataFrame, strict_user_id: bool = True,
                  num_partitions: int | None = None, distinct: bool = False) -> DataFrame:
    """The plays of :func:`prepare_plays` before numbering: distinct, cleaned,
    derived, with partitions in global event-time order.

    Distinct comes first, as a partial aggregate, so a line that holds a third of
    the log costs one row per task. Its result is stored, so the range sampling
    and the range shuffle read distinct rows and no line is parsed again.
    ``distinct``: ``log_raw`` holds distinct plays already, in a stored table."""
    order = ["ts"] + [c for c in log_raw.columns if c != "ts"]
    rows = log_raw if distinct else stored(log_raw.filter(F.col("page") == NEXT_SONG).dropDuplicates(), "distinct-plays")
    ranged = _by_range(rows, order, num_partitions).sortWithinPartitions(*order)
    plays = clean_frame(ranged.drop("_extra"))
    plays = plays.withColumn("start_time", epoch_ms_to_start_time("ts"))
    plays = plays.withColumns(time_part_columns("start_time"))
    number, rejected = convert(F.col("userId"), "int")
    if strict_user_id:
        number = F.when(rejected, F.raise_error(F.concat(F.lit("not a number in userId: "), "userId"))).otherwise(number)
    else:
        plays = plays.withColumn("rejected_user_id", F.when(rejected, F.col("userId")))
    return plays.withColumn("userId", number.cast("int"))


def rejected_plays(plays: DataFrame) -> DataFrame:
    """(userId text, plays) of the ids that a lenient :func:`prepare_plays` rejected."""
    return (plays.filter(F.col("rejected_user_id").isNotNull())
            .groupBy(F.col("rejected_user_id").alias("user_id")).agg(F.count(F.lit(1)).alias("n_plays")))


def build_times(plays: DataFrame) -> DataFrame:
    return plays.select(F.col("songplay_id").alias("time_id"), *TIME_COLUMNS)


def build_users(plays: DataFrame) -> DataFrame:
    """One row per user: attributes and level of the user's last play by
    event time (then by play id)."""
    u = plays.filter(F.col("userId").isNotNull()).select(
        F.col("userId").alias("user_id"), F.col("firstName").alias("first_name"),
        F.col("lastName").alias("last_name"), "gender", "level", "ts", "songplay_id")
    return keep_last(u, ["user_id"], ["ts", "songplay_id"]).select(
        "user_id", "first_name", "last_name", "gender", "level")


def user_attribute_conflicts(plays: DataFrame) -> DataFrame:
    """Users whose name or gender differs between plays (they would give two
    rows for one key under a keep-last on all four attributes)."""
    return (plays.groupBy(F.col("userId").alias("user_id"))
            .agg(F.count_distinct(F.struct("firstName", "lastName", "gender")).alias("n_variants"))
            .filter(F.col("n_variants") > 1))


def build_songplays(plays: DataFrame, catalog: DataFrame) -> DataFrame:
    looked = lookup_song_artist(plays, catalog, "artist", "song", "length")
    return looked.select(
        "songplay_id", F.col("songplay_id").alias("time_id"), F.col("userId").alias("user_id"),
        "level", "song_id", "artist_id", F.col("sessionId").alias("session_id"), "location",
        F.col("userAgent").alias("user_agent"))


def run_pipeline(spark: SparkSession, song_dir: str, log_dir: str, out_dir: str,
                 check: bool = True, on_conflict: str = "error", database: str | None = None,
                 buckets: int | None = None, on_bad: str = "fail") -> dict[str, DataFrame]:
    """JSON folders -> the next version of the five tables in ``out_dir``
    (``sinks.versioned``). They are written to a new folder, all constraints are
    checked on what was written (``check=False`` skips), and one commit publishes all
    five. A run that fails, or dies on the way, leaves the last version in force; a
    rerun publishes equal tables.

    A malformed line and a repeated song or artist id stop the run; with
    ``on_bad`` / ``on_conflict`` = ``'quarantine'`` they are stored under
    ``out_dir/quarantine/`` instead (``song_lines``, ``log_lines``, ``songs``,
    ``artists``). Plays are always looked up under every distinct spelling.
    Users whose name or gender changed between plays are reported in
    ``out_dir/quarantine/user_variants``.

    With ``database`` the tables are also in the catalog, as views of the published
    version (:func:`point_views` renews them after a crash between commit and views),
    and with ``buckets`` the fact and ``times`` are stored bucketed and sorted on
    ``time_id`` (``users`` on ``user_id``). The fact-times join of the hour
    report then reads co-located buckets instead of shuffling both sides."""
    out = out_dir.rstrip("/")

    def read(reader, folder: str, name: str) -> DataFrame:
        if on_bad == "fail":
            return reader(spark, folder, distinct=False, keep_extra=True)
        lines = reader(spark, folder, distinct=False, keep_extra=True, on_bad=on_bad)
        good, bad = split_bad(stored(lines, name))
        write_table(bad, f"{out}/quarantine/{name}")
        return good

    song_raw = stored(read(read_song_data, song_dir, "song_lines").drop("_extra").dropDuplicates(), "songs")
    plays = prepare_plays(read(read_log_data, log_dir, "log_lines"))
    artists, songs = stored(all_artists(song_raw), "artists"), stored(all_songs(song_raw), "songs")
    if on_conflict == "quarantine":
        for name, rows, key in (("artists", artists, "artist_id"), ("songs", songs, "song_id")):
            write_table(split_conflicts(rows, key)[1], f"{out}/quarantine/{name}")
    write_table(user_attribute_conflicts(plays), f"{out}/quarantine/user_variants")
    built = {"artists": lambda: _resolve(artists, "artist_id", on_conflict, "artists"),
             "songs": lambda: _resolve(songs, "song_id", on_conflict, "songs"),
             "times": lambda: build_times(plays),
             "users": lambda: build_users(plays),
             "songplays": lambda: build_songplays(plays, song_artist_catalog(songs, artists))}
    store = VersionedTables(spark, out)
    stage = store.stage()
    staged: dict[str, DataFrame] = {}
    try:
        if database:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        for name, build in built.items():
            staged[name] = _store(spark, stage, name, build(), database, buckets)
        if check:
            check_star(staged)
            assert_row_counts_equal(staged["songplays"], staged["times"], "songplays", "times")
    except BaseException:
        if database:
            for name in built:
                spark.sql(f"DROP TABLE IF EXISTS {database}.{_version_name(name, stage.folder)}")
        stage.discard()
        raise
    stage.commit()
    if database:
        point_views(spark, out, database)
        return {name: spark.table(f"{database}.{name}") for name in built}
    return {name: store.read(name) for name in built}


#: Bucket key and partition folders of the stored tables.
_STORED = {"times": ("time_id", ("year", "month")), "users": ("user_id", ()), "songplays": ("time_id", ())}


def _version_name(name: str, folder: str) -> str:
    return f"{name}__{folder.rsplit('/', 1)[1][:16]}"


def _store(spark: SparkSession, stage: Stage, name: str, df: DataFrame, database: str | None,
           buckets: int | None) -> DataFrame:
    """Writes one table to the stage; the table as it was written."""
    key, partition_by = _STORED.get(name, (None, ()))
    table = f"{database}.{_version_name(name, stage.folder)}"
    if database and buckets and key:
        save_bucketed_table(df, table, key, buckets, stage.path(name))
        stage.adopt(name, spark.table(table).schema)
        return spark.table(table)
    stage.write(name, df, Layout(partition_by=partition_by))
    if not database:
        return stage.tables()[name]
    spark.catalog.createTable(table, path=stage.path(name), source="parquet")
    if partition_by:
        spark.catalog.recoverPartitions(table)
    return spark.table(table)


def point_views(spark: SparkSession, out_dir: str, database: str) -> None:
    """Sets the views ``database.songs``, ... to the published version's tables, and
    drops the catalog entries (not the files) of all but the last two versions."""
    store = VersionedTables(spark, out_dir)
    kept: set[str] = set()
    for number in store.log.numbers()[-2:]:
        for name, entry in store.manifest(number).items():
            kept.add(_version_name(name, entry["parts"][""][0].rsplit("/", 1)[0]))
    for name, entry in store.manifest().items():
        # a session's temporary views are listed with every database
        current = {t.name: t.tableType for t in spark.catalog.listTables(database, f"{name}*") if not t.isTemporary}
        if name in current and current[name] != "VIEW":  # an empty table of ``catalog.reset_warehouse``
            spark.sql(f"DROP TABLE {database}.{name}")
        version = _version_name(name, entry["parts"][""][0].rsplit("/", 1)[0])
        columns = ", ".join(f"`{f['name']}`" for f in json.loads(entry["schema"])["fields"])
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS SELECT {columns} FROM {database}.{version}")
        for old in current:
            if old.startswith(f"{name}__") and old not in kept:
                spark.sql(f"DROP TABLE IF EXISTS {database}.{old}")
