"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator key of the coverage list. Each runs the library function on the
driver-table analogue of ``playstats.plans.analogues``; DuckDB SQL for the
same result is in ``playstats.plans.oracle``.

Floating results are rounded to 6 decimals (presentation only), and every
limit follows a total order, so results compare exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playstats import operators as ops
from playstats.functions.cleaning import clean_frame, flag_numeric
from playstats.functions.text import full_name
from playstats.functions.timeparts import epoch_ms_to_start_time, ntz_to_epoch_ms, time_part_columns
from playstats.operators import profile, quality
from playstats.operators.sequence import Sequence
from playstats.plans import analogues as an
from playstats.plans import catalog, increment, reports, star
from playstats.schemas import SONG_SCHEMA, USERS
from playstats.scratch import scratch_path
from playstats.sinks import dml, writers
from playstats.sinks.versioned import Layout, VersionedTables
from playstats.sources import delimited, files, tables
from playstats.sources.ledger import FileLedger
from playstats.plans.analogues import DriverTables

Query = Callable[[SparkSession, str], DataFrame]

# Fixed parameters of the registered queries.
POINT_USER = 42
CAST_EQ_TEXT = "88"
LOOKUP_POINT = ("Brand#2", "small ring", 900.0)
BUSY_DAY_MIN = 8
TOP_K = 10
BUCKETS = 8
#: Added to a key so that no other table holds it.
ABSENT = 1_000_000_000


def _r6(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), 6) for c in cols})


# ---------------------------------------------------------------- scans, projections, filters

def q_scan_table(spark: SparkSession, sf: str) -> DataFrame:
    return tables.scan_table(spark, f"{sf}/customer.parquet")


def q_project_columns(spark: SparkSession, sf: str) -> DataFrame:
    return DriverTables(spark, sf).events.select("user_id", "event_type", "ts")


def q_project_rename(spark: SparkSession, sf: str) -> DataFrame:
    return DriverTables(spark, sf).customer.withColumnsRenamed(
        {"c_custkey": "user_id", "c_name": "user_name", "c_nationkey": "nation_id"})


def q_project_drop(spark: SparkSession, sf: str) -> DataFrame:
    return DriverTables(spark, sf).events.drop("props")


def _paged_events(t: DriverTables) -> DataFrame:
    return t.events.select("event_id", "user_id", F.when(F.col("user_id") % 7 == 0, F.lit(None).cast("string"))
                           .when(F.col("event_type") == "view", F.lit("NextSong"))
                           .otherwise(F.col("event_type")).alias("page"))


def q_filter_page(spark: SparkSession, sf: str) -> DataFrame:
    return _paged_events(DriverTables(spark, sf)).filter(F.col("page") == star.NEXT_SONG)


def q_filter_point(spark: SparkSession, sf: str) -> DataFrame:
    return DriverTables(spark, sf).customer.filter(F.col("c_custkey") == POINT_USER)


def q_filter_cast_eq(spark: SparkSession, sf: str) -> DataFrame:
    return DriverTables(spark, sf).events.filter(F.col("user_id").cast("string") == CAST_EQ_TEXT)


def _catalog(t: DriverTables) -> DataFrame:
    return ops.song_artist_catalog(an.songs_of(t.part), an.artists_of(t.part))


def _looked_up(t: DriverTables) -> DataFrame:
    plays = an.plays_with_song_fields(t)
    return ops.lookup_song_artist(plays, _catalog(t)).select(
        F.col("event_id").alias("songplay_id"), "song_id", "artist_id")


def q_filter_not_null(spark: SparkSession, sf: str) -> DataFrame:
    return _looked_up(DriverTables(spark, sf)).filter(F.col("song_id").isNotNull())


def q_full_name(spark: SparkSession, sf: str) -> DataFrame:
    u = an.users_of(DriverTables(spark, sf).customer)
    return u.select("user_id", full_name("first_name", "last_name").alias("user_fullname"))


# ---------------------------------------------------------------- file sources and sinks

def _events_json(t: DriverTables, root: str, copies: bool) -> str:
    """Events as a JSON Lines folder, one sub-folder per kind. With ``copies``
    also a second, identical copy in a nested folder (removed by the distinct),
    an editor-checkpoint copy with altered values and a stray text file (both
    must not be read, or extra rows would appear)."""
    ev = t.events.withColumn("kind", F.col("event_type"))
    writers.write_table(ev, f"{root}/a", fmt="json", partition_by=["kind"])
    if copies:
        writers.write_table(ev.drop("kind"), f"{root}/b/nested", fmt="json")
        writers.write_table(ev.drop("kind").withColumn("value", F.col("value") + 1000),
                            f"{root}/.ipynb_checkpoints", fmt="json")
        writers.write_table(ev.select(F.col("event_type").alias("value")).dropDuplicates(),
                            f"{root}/stray", fmt="text")
    return root


def q_scan_json_lines(spark: SparkSession, sf: str) -> DataFrame:
    t = DriverTables(spark, sf)
    root = _events_json(t, scratch_path(spark, "scan_json_lines"), copies=True)
    return files.read_json_lines(spark, root, t.events.schema)


def q_scan_with_filename(spark: SparkSession, sf: str) -> DataFrame:
    t = DriverTables(spark, sf)
    root = _events_json(t, scratch_path(spark, "scan_with_filename"), copies=False)
    df = files.read_json_lines(spark, root, t.events.schema, distinct=False,
                               source_file_col="source_file")
    return df.select("event_id", files.parent_folder("source_file").alias("folder"))


def q_scan_file_listing(spark: SparkSession, sf: str) -> DataFrame:
    t = DriverTables(spark, sf)
    root = _events_json(t, scratch_path(spark, "scan_file_listing"), copies=True)
    listed = files.list_files(spark, root)
    return listed.select(files.parent_folder("file_path").alias("folder")).dropDuplicates()


def q_scan_new_files(spark: SparkSession, sf: str) -> DataFrame:
    """What a second run reads after the views were delivered as new files."""
    t = DriverTables(spark, sf)
    root, notes = scratch_path(spark, "scan_new_files"), FileLedger(spark, scratch_path(spark, "ledger"))
    is_view = F.col("event_type") == "view"
    writers.write_table(t.events.filter(~is_view), f"{root}/first", fmt="json")
    notes.pending(root).commit()
    writers.write_table(t.events.filter(is_view), f"{root}/second", fmt="json")
    new = notes.pending(root)
    rows = new.read(lambda paths: files.read_json_lines(spark, paths, t.events.schema, distinct=False))
    new.commit()
    return rows


def _dirty_customers(t: DriverTables) -> DataFrame:
    k = F.col("c_custkey")
    name = (F.when(k % 7 == 0, F.concat("c_name", F.lit("\ttab")))
            .when(k % 7 == 1, F.concat("c_name", F.lit('"quoted"')))
            .when(k % 7 == 2, F.concat("c_name", F.lit(",comma")))
            .when(k % 7 == 3, F.concat("c_name", F.lit("\\back")))
            .when(k % 7 == 4, F.lit(""))
            .when(k % 7 == 5, F.lit("NULL"))
            .when(k % 3 == 0, F.concat(F.lit(" \n"), "c_name", F.lit("\r\n\\n ")))
            .when(k % 3 == 1, F.lit("\u0001"))
            .otherwise(F.lit("\\N")))
    seg = F.when(k % 13 == 0, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment"))
    return t.customer.select("c_custkey", name.alias("c_name"), "c_acctbal", seg.alias("c_mktsegment"))


def q_tsv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    t = DriverTables(spark, sf)
    df = _dirty_customers(t)
    path = writers.write_tsv(df, scratch_path(spark, "tsv_round_trip"))
    return delimited.read_tsv(spark, path, df.schema)


def q_csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    t = DriverTables(spark, sf)
    df = _dirty_customers(t)
    path = writers.write_csv(df, scratch_path(spark, "csv_round_trip"))
    return delimited.read_csv(spark, path, df.schema)


def q_write_read_table(spark: SparkSession, sf: str) -> DataFrame:
    songs = an.songs_of(DriverTables(spark, sf).part)
    path = writers.write_table(songs, scratch_path(spark, "write_read_table"), partition_by=["year"])
    return tables.scan_table(spark, path).select("song_id", "title", "artist_id", "year", "duration")


def q_insert_rows(spark: SparkSession, sf: str) -> DataFrame:
    users = an.users_of(DriverTables(spark, sf).customer)
    name = catalog.fresh_table_name("users_insert")
    writers.create_table(spark, name, USERS, scratch_path(spark, "insert_rows"))
    writers.insert_rows(spark, name, users.filter(F.col("level") == "paid"))
    writers.insert_rows(spark, name, users.filter(F.col("level") == "free"))
    return spark.table(name)


# ---------------------------------------------------------------- cleaning and time

def q_time_parts(spark: SparkSession, sf: str) -> DataFrame:
    ev = DriverTables(spark, sf).events
    st = epoch_ms_to_start_time(ntz_to_epoch_ms("ts"))
    return ev.select("event_id", st.alias("start_time")).withColumns(time_part_columns("start_time"))


def _dirty_events(t: DriverTables) -> DataFrame:
    m = F.col("event_id") % 10
    props = (F.when(m == 0, F.lit("")).when(m == 1, F.lit("\t"))
             .when(m == 2, F.lit("a\tb")).when(m == 3, F.lit(None).cast("string"))
             .when(m == 4, F.lit("NULL")).otherwise(F.col("props")))
    value = F.when(F.col("event_id") % 13 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    return t.events.select("event_id", "event_type", props.alias("props"), value.alias("value"))


def q_clean_frame(spark: SparkSession, sf: str) -> DataFrame:
    return clean_frame(_dirty_events(DriverTables(spark, sf)))


def q_to_number(spark: SparkSession, sf: str) -> DataFrame:
    ev = DriverTables(spark, sf).events
    text = (F.when(F.col("event_id") % 17 == 0, F.lit(""))
            .when(F.col("event_id") % 19 == 0, F.lit("abc"))
            .otherwise(F.col("user_id").cast("string")))
    return flag_numeric(ev.select("event_id", text.alias("user_id")), "user_id", "int")


# ---------------------------------------------------------------- distinct, duplicates, keys

def _order_days(t: DriverTables) -> DataFrame:
    return t.orders.select("o_orderdate", "o_orderstatus")


def q_distinct_rows(spark: SparkSession, sf: str) -> DataFrame:
    return ops.distinct_rows(DriverTables(spark, sf).orders.select(
        "o_orderstatus", "o_orderdate", "o_orderpriority"))


def q_distinct_stored(spark: SparkSession, sf: str) -> DataFrame:
    """Whole rows of a stored table into which every tenth order was loaded again."""
    orders = DriverTables(spark, sf).orders
    path = scratch_path(spark, "orders-twice")
    writers.write_table(orders.unionAll(orders.filter(F.col("o_orderkey") % 10 == 0)), path)
    return ops.distinct_stored(spark, path)


def q_distinct_projection(spark: SparkSession, sf: str) -> DataFrame:
    return ops.distinct_projection(DriverTables(spark, sf).part, ["p_brand", "p_type"])


def q_dup_rows_all(spark: SparkSession, sf: str) -> DataFrame:
    return ops.duplicate_members(_order_days(DriverTables(spark, sf)))


def q_dup_rows_subset(spark: SparkSession, sf: str) -> DataFrame:
    """Duplicates by date and status; the key and clerk-side columns stay in the result."""
    orders = DriverTables(spark, sf).orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    return ops.duplicate_members(orders, ["o_orderdate", "o_orderstatus"])


def q_dup_count(spark: SparkSession, sf: str) -> DataFrame:
    return ops.duplicate_summary(_order_days(DriverTables(spark, sf)))


def q_groups_larger_than(spark: SparkSession, sf: str) -> DataFrame:
    o = DriverTables(spark, sf).orders.select("o_orderkey", "o_orderdate")
    return ops.groups_larger_than(o, ["o_orderdate"], BUSY_DAY_MIN)


def q_key_cardinality(spark: SparkSession, sf: str) -> DataFrame:
    ev = DriverTables(spark, sf).events
    uid = F.when(F.col("user_id") % 10 == 3, F.lit(None).cast("long")).otherwise(F.col("user_id"))
    return profile.key_cardinality(ev.select(uid.alias("user_id")), "user_id")


def q_dedup_keep_last(spark: SparkSession, sf: str) -> DataFrame:
    ev = DriverTables(spark, sf).events.select("user_id", "event_type", "ts", "event_id")
    return ops.keep_last(ev, ["user_id"], ["ts", "event_id"])


def q_surrogate_id(spark: SparkSession, sf: str) -> DataFrame:
    v = an.views(DriverTables(spark, sf).events).select("event_id", "ts")
    return ops.assign_surrogate_id(v, ["ts", "event_id"], "songplay_id").select("event_id", "songplay_id")


def q_surrogate_id_continued(spark: SparkSession, sf: str) -> DataFrame:
    """Two loads numbered one after the other; the first one is tried twice."""
    v = an.views(DriverTables(spark, sf).events).select("event_id", "ts")
    ids = Sequence(spark, scratch_path(spark, "sequence"), "songplay_id")
    even, odd = v.filter(F.col("event_id") % 2 == 0), v.filter(F.col("event_id") % 2 == 1)
    ids.number(even, ["ts", "event_id"], "even", "songplay_id")
    later = ids.number(odd, ["ts", "event_id"], "odd", "songplay_id")
    again = ids.number(even, ["ts", "event_id"], "even", "songplay_id")
    return again.unionByName(later).select("event_id", "songplay_id")


def q_patch_by_key(spark: SparkSession, sf: str) -> DataFrame:
    t = DriverTables(spark, sf)
    plays = an.plays_with_song_fields(t).select("event_id", "artist", "song", "length")
    # parts above size 10 patch keys that no play has
    patch = t.part.select(
        F.when(F.col("p_size") <= 10, F.col("p_partkey") + 3).otherwise(-F.col("p_partkey")).alias("event_id"),
        F.col("p_brand").alias("artist"),
        F.col("p_name").alias("song"), F.col("p_retailprice").alias("length"))
    return ops.patch_by_key(plays, patch, "event_id", ["artist", "song", "length"])


# ---------------------------------------------------------------- joins and lookup

def q_join_songs_artists(spark: SparkSession, sf: str) -> DataFrame:
    t = DriverTables(spark, sf)
    return ops.join_songs_artists(an.songs_of(t.part), an.artists_of(t.part))


def q_lookup_song_artist(spark: SparkSession, sf: str) -> DataFrame:
    return _looked_up(DriverTables(spark, sf))


def q_lookup_point(spark: SparkSession, sf: str) -> DataFrame:
    artist, title, duration = LOOKUP_POINT
    return ops.lookup_point(_catalog(DriverTables(spark, sf)), artist, title, duration)


# ---------------------------------------------------------------- star-schema builds from JSON

_FOLDERS: dict[tuple[str, str, str], str] = {}


def _folder(spark: SparkSession, t: DriverTables, name: str, write) -> str:
    """The JSON folder of one scale factor, written once per session."""
    key = (spark.sparkContext.applicationId, t.sf_dir, name)
    if key not in _FOLDERS:
        _FOLDERS[key] = write(t, scratch_path(spark, name))
    return _FOLDERS[key]


def _song_raw(spark, t):
    return star.read_song_data(spark, _folder(spark, t, "song_data", an.write_song_folder))


def _plays(spark, t):
    root = _folder(spark, t, "log_data", an.write_log_folder)
    return star.prepare_plays(star.read_log_data(spark, root, distinct=False, keep_extra=True))


def q_etl_songs(spark: SparkSession, sf: str) -> DataFrame:
    return star.build_songs(_song_raw(spark, DriverTables(spark, sf)))


def q_etl_artists(spark: SparkSession, sf: str) -> DataFrame:
    return star.build_artists(_song_raw(spark, DriverTables(spark, sf)))


def q_etl_times(spark: SparkSession, sf: str) -> DataFrame:
    return star.build_times(_plays(spark, DriverTables(spark, sf)))


def q_etl_users(spark: SparkSession, sf: str) -> DataFrame:
    return star.build_users(_plays(spark, DriverTables(spark, sf)))


def q_etl_songplays(spark: SparkSession, sf: str) -> DataFrame:
    t = DriverTables(spark, sf)
    raw = _song_raw(spark, t)
    cat = ops.song_artist_catalog(star.build_songs(raw), star.build_artists(raw))
    return star.build_songplays(_plays(spark, t), cat)


def q_etl_pipeline(spark: SparkSession, sf: str) -> DataFrame:
    """The whole run into a database with bucketed tables: every stored table's row
    count, and the hour report from the stored tables."""
    t = DriverTables(spark, sf)
    db = catalog.fresh_table_name("playstats_run")
    catalog.create_database(spark, db, scratch_path(spark, db))
    tables = star.run_pipeline(spark, _folder(spark, t, "song_data", an.write_song_folder),
                               _folder(spark, t, "log_data", an.write_log_folder), scratch_path(spark, "run"),
                               database=db, buckets=BUCKETS)
    return _run_facts(tables)


def _run_facts(tables: dict[str, DataFrame]) -> DataFrame:
    hours = reports.plays_by_hour(tables["songplays"], tables["times"])
    out = hours.select(F.lit("hour").alias("item"), F.col("hour").cast("string").alias("name"),
                       F.col("songplays_counter").alias("n"))
    for name, df in tables.items():
        out = out.unionAll(df.agg(F.lit("rows"), F.lit(name), F.count(F.lit(1))))
    return out


def q_etl_increment(spark: SparkSession, sf: str) -> DataFrame:
    """The run of ``etl_pipeline`` as two loads: first a part of the songs and the plays
    of one delivery, then the folders' new files, which repeat those plays."""
    t = DriverTables(spark, sf)
    songs, logs, out = (scratch_path(spark, x) for x in ("songs", "logs", "increments"))
    song_rows, log_rows = an.song_records_of(t.part), an.log_records_of(t)
    writers.write_table(song_rows.filter(F.col("year") <= 20), f"{songs}/A", fmt="json")
    writers.write_table(log_rows.filter((F.col("page") == star.NEXT_SONG) & (F.col("level") == "paid")), f"{logs}/paid", fmt="json")
    increment.run_increment(spark, songs, logs, out, buckets=BUCKETS)
    writers.write_table(song_rows.filter(F.col("year") >= 20), f"{songs}/B", fmt="json")
    writers.write_table(log_rows.withColumn("kind", F.col("page")), f"{logs}/all", fmt="json", partition_by=["kind"])
    return _run_facts(increment.run_increment(spark, songs, logs, out, buckets=BUCKETS))


# ---------------------------------------------------------------- reports

def q_report_by_hour_stored(spark: SparkSession, sf: str) -> DataFrame:
    """The hour report on tables stored in buckets of ``time_id``: the join reads
    co-located buckets and exchanges nothing."""
    ev = DriverTables(spark, sf).events
    names = []
    for df, name in ((an.plain_plays(ev), "songplays"), (an.times_of(ev).select("time_id", "hour"), "times")):
        names.append(writers.save_bucketed_table(df, catalog.fresh_table_name(name), "time_id", BUCKETS,
                                                 scratch_path(spark, name)))
    return reports.plays_by_hour(*(spark.table(n) for n in names))


def q_report_by_hour(spark: SparkSession, sf: str) -> DataFrame:
    ev = DriverTables(spark, sf).events
    return reports.plays_by_hour(an.plain_plays(ev), an.times_of(ev))


def q_report_by_location(spark: SparkSession, sf: str) -> DataFrame:
    return _r6(reports.plays_by_location(an.located_plays(DriverTables(spark, sf))), "songplays_percent")


def q_report_top_users(spark: SparkSession, sf: str) -> DataFrame:
    t = DriverTables(spark, sf)
    return reports.top_users(an.plain_plays(t.events), an.users_of(t.customer))


def q_count_by_user(spark: SparkSession, sf: str) -> DataFrame:
    t = DriverTables(spark, sf)
    return reports.plays_per_user(an.plain_plays(t.events), an.users_of(t.customer))


def q_count_total(spark: SparkSession, sf: str) -> DataFrame:
    return reports.total_plays(an.plain_plays(DriverTables(spark, sf).events))


def q_count_stored(spark: SparkSession, sf: str) -> DataFrame:
    """Row counts of stored tables without reading a column."""
    return tables.stored_counts(spark, {n: f"{sf}/{n}.parquet" for n in ("customer", "events", "part")})


def q_topk_users(spark: SparkSession, sf: str) -> DataFrame:
    t = DriverTables(spark, sf)
    return reports.top_k_users(an.plain_plays(t.events), an.users_of(t.customer), TOP_K)


def q_topk_locations(spark: SparkSession, sf: str) -> DataFrame:
    return reports.top_k_locations(an.located_plays(DriverTables(spark, sf)), TOP_K)


def q_topk_share(spark: SparkSession, sf: str) -> DataFrame:
    return reports.top_k_location_share(an.located_plays(DriverTables(spark, sf)), TOP_K)


def q_limit_n(spark: SparkSession, sf: str) -> DataFrame:
    return ops.limit_n(an.located_plays(DriverTables(spark, sf)), 5, ["songplay_id"])


def q_head_tail(spark: SparkSession, sf: str) -> DataFrame:
    return ops.head_tail(DriverTables(spark, sf).events, 3, ["event_id"])


def q_slice_rows(spark: SparkSession, sf: str) -> DataFrame:
    return ops.slice_rows(DriverTables(spark, sf).events, ["ts", "event_id"], 3, 13)


# ---------------------------------------------------------------- DML

def _dml_inputs(t: DriverTables) -> tuple[DataFrame, DataFrame]:
    users = an.users_of(t.customer)
    # stored: every user, the paid ones under ids that no event has
    target = users.withColumn("user_id", F.when(F.col("level") == "free", F.col("user_id"))
                              .otherwise(F.col("user_id") + ABSENT).cast("int"))
    first = F.when(F.col("event_id") % 2 == 0, F.lit("Even")).otherwise(F.lit("Odd"))
    ev = t.events.select(F.col("user_id").cast("int").alias("user_id"), "event_id", "ts", "event_type")
    batch = (ev.join(users.select("user_id", "last_name", "gender"), "user_id")
             .select("user_id", first.alias("first_name"), "last_name", "gender",
                     F.col("event_type").alias("level"), "ts", "event_id"))
    return target, batch


def _published_users(spark: SparkSession, users: DataFrame) -> VersionedTables:
    """Version 1 of a users table in buckets of its key."""
    store = VersionedTables(spark, scratch_path(spark, "users"))
    store.publish({"users": users}, {"users": Layout("user_id", BUCKETS)})
    return store


def q_upsert_level(spark: SparkSession, sf: str) -> DataFrame:
    """Published as a new version and read back."""
    target, batch = _dml_inputs(DriverTables(spark, sf))
    store = _published_users(spark, target)
    store.upsert("users", batch, ["level"], ["ts", "event_id"])
    return store.read("users")


def q_insert_if_absent(spark: SparkSession, sf: str) -> DataFrame:
    """Appended and read back, on a plain table."""
    target, batch = _dml_inputs(DriverTables(spark, sf))
    name = catalog.fresh_table_name("users")
    target.write.format("parquet").option("path", scratch_path(spark, "users-plain")).saveAsTable(name)
    dml.append_if_absent(spark, name, batch, "user_id", ["ts", "event_id"])
    return spark.table(name)


def q_delete_by_key(spark: SparkSession, sf: str) -> DataFrame:
    """Published as a new version with a delete vector, and read back."""
    t = DriverTables(spark, sf)
    keys = t.events.filter((F.col("event_type") == "error") & (F.col("value") > 90)).select("user_id")
    store = _published_users(spark, an.users_of(t.customer))
    store.delete("users", keys)
    return store.read("users")


# ---------------------------------------------------------------- quality checks

def q_check_primary_key(spark: SparkSession, sf: str) -> DataFrame:
    return quality.primary_key_violations(DriverTables(spark, sf).lineitem, ["l_orderkey", "l_linenumber"])


def q_check_foreign_key(spark: SparkSession, sf: str) -> DataFrame:
    t = DriverTables(spark, sf)
    # small parts stand under another key, so their lines are orphans
    parent = t.part.select(F.when(F.col("p_size") > 5, F.col("p_partkey")).otherwise(-F.col("p_partkey"))
                           .alias("p_partkey"))
    return quality.foreign_key_violations(t.lineitem, ["l_partkey"], parent, ["p_partkey"])


def q_check_not_null(spark: SparkSession, sf: str) -> DataFrame:
    users = an.users_of(DriverTables(spark, sf).customer)
    return quality.null_counts(users, users.columns)


def q_check_row_counts(spark: SparkSession, sf: str) -> DataFrame:
    orders = DriverTables(spark, sf).orders
    path = writers.write_table(orders, scratch_path(spark, "check_row_counts"))
    return quality.row_count_check(orders, spark.read.parquet(path), "orders")


def q_check_rows_per_file(spark: SparkSession, sf: str) -> DataFrame:
    songs = an.song_records_of(DriverTables(spark, sf).part)
    # one file per brand (a bounded number of files), so rows and files differ
    root = writers.write_table(songs.withColumn("brand", F.col("artist_id")).repartition("brand"),
                               scratch_path(spark, "songs_by_brand"), fmt="json", partition_by=["brand"])
    df = files.read_json_lines(spark, root, SONG_SCHEMA, distinct=False, source_file_col="source_file")
    return quality.rows_per_file_check(df)


# ---------------------------------------------------------------- profiles

def q_profile_text(spark: SparkSession, sf: str) -> DataFrame:
    return profile.profile_text(DriverTables(spark, sf).orders, ["o_orderstatus", "o_orderpriority"])


def q_profile_numeric(spark: SparkSession, sf: str) -> DataFrame:
    nan = F.when(F.col("l_linenumber") == 2, F.lit(float("nan")))
    lines = DriverTables(spark, sf).lineitem.withColumn("l_discount", F.coalesce(nan, F.col("l_discount")))
    p = profile.profile_numeric(lines, ["l_quantity", "l_discount", "l_tax"])
    return _r6(p, "mean", "std", "min", "p25", "p50", "p75", "max")


def q_profile_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    return profile.profile_timestamp(DriverTables(spark, sf).orders, ["o_orderdate"])


def q_profile_dtypes(spark: SparkSession, sf: str) -> DataFrame:
    return profile.profile_dtypes(DriverTables(spark, sf).events)


# ---------------------------------------------------------------- set operations, catalog

def q_union_by_name(spark: SparkSession, sf: str) -> DataFrame:
    t = DriverTables(spark, sf)
    s = t.supplier.withColumnsRenamed({"s_suppkey": "key", "s_name": "name", "s_nationkey": "nationkey",
                                       "s_acctbal": "acctbal"})
    c = t.customer.withColumnsRenamed({"c_custkey": "key", "c_name": "name", "c_nationkey": "nationkey",
                                       "c_acctbal": "acctbal", "c_mktsegment": "mktsegment"})
    return s.unionByName(c, allowMissingColumns=True)


def q_catalog_tables(spark: SparkSession, sf: str) -> DataFrame:
    t = DriverTables(spark, sf)
    db = catalog.fresh_table_name("playstats_catalog")
    catalog.create_database(spark, db, scratch_path(spark, db))
    for name, df in (("users", an.users_of(t.customer)), ("songs", an.songs_of(t.part)),
                     ("artists", an.artists_of(t.part))):
        df.write.mode("overwrite").option("path", scratch_path(spark, f"{db}-{name}")) \
            .saveAsTable(f"{db}.{name}")
    counts = None
    for row in catalog.list_tables(spark, db).collect():        # the three tables stored above
        one = spark.table(f"{db}.{row.table_name}").agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(row.table_name).alias("table_name"), "n_rows")
        counts = one if counts is None else counts.unionAll(one)
    return counts


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
