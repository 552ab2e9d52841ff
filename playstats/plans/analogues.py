"""The driver's tables seen as play logs (how each registered query gets data).

The driver ships TPC-H-like tables, not play logs, so each query runs the
library on an analogue; the same derivation is spelled out in SQL in
``playstats.plans.oracle`` so DuckDB can compute the expected result.

* plays    = ``events`` rows with ``event_type = 'view'`` (the NextSong page),
             play id and time id = ``event_id``
* users    = ``customer``: first/last name = the two halves of ``c_name`` around
             ``#`` (last name NULL for every 11th key), level from the balance
* location = nation name of the playing user (NULL for every 9th user id)
* songs    = ``part``: title ``p_name``, artist ``p_brand``, year ``p_size``,
             duration ``p_retailprice``; artists = distinct ``p_brand``
* a play's (artist, title, length) = the part whose key equals its event id
  (events beyond the last part stay unmatched)

Fixed values of the analogue (must equal the SQL side): NextSong page name,
modulus rules 7/9/11/13, the ``S`` + 10-digit song id format.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playstats.functions.timeparts import floor_to_second, ntz_to_epoch_ms, time_part_columns
from playstats.sinks.writers import write_table
from playstats.sources.tables import driver_table

TAB = "\t"


class DriverTables:
    """Lazy access to the driver's parquet tables of one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return driver_table(self.spark, self.sf_dir, name)


def song_id_of(partkey: Column) -> Column:
    return F.concat(F.lit("S"), F.lpad(partkey.cast("string"), 10, "0"))


def brand_number(brand: Column) -> Column:
    return F.split_part(brand, F.lit("#"), F.lit(2)).cast("int")


def users_of(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    return customer.select(
        k.cast("int").alias("user_id"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
        F.when(k % 11 == 0, F.lit(None).cast("string"))
        .otherwise(F.split_part("c_name", F.lit("#"), F.lit(2))).alias("last_name"),
        F.when(k % 2 == 0, F.lit("F")).otherwise(F.lit("M")).alias("gender"),
        F.when(F.col("c_acctbal") >= 5000, F.lit("paid")).otherwise(F.lit("free")).alias("level"))


def songs_of(part: DataFrame) -> DataFrame:
    return part.select(song_id_of(F.col("p_partkey")).alias("song_id"), F.col("p_name").alias("title"),
                       F.col("p_brand").alias("artist_id"), F.col("p_size").alias("year"),
                       F.col("p_retailprice").alias("duration"))


def artists_of(part: DataFrame) -> DataFrame:
    bn = brand_number(F.col("p_brand"))
    return part.select(
        F.col("p_brand").alias("artist_id"), F.col("p_brand").alias("name"),
        F.when(bn % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("City "), bn.cast("string"))).alias("location"),
        F.when(bn % 3 == 0, F.lit(None).cast("double")).otherwise(bn.cast("double")).alias("latitude"),
        (-bn).cast("double").alias("longitude")).dropDuplicates()


def song_records_of(part: DataFrame) -> DataFrame:
    """Song-metadata objects as the song folder holds them."""
    a = artists_of(part).withColumnsRenamed({"name": "artist_name", "location": "artist_location",
                                             "latitude": "artist_latitude",
                                             "longitude": "artist_longitude"})
    return (songs_of(part).join(a, "artist_id")
            .select("song_id", "title", "artist_id", "year", "duration", "artist_name",
                    "artist_location", "artist_latitude", "artist_longitude",
                    F.lit(1).alias("num_songs")))


def views(events: DataFrame) -> DataFrame:
    return events.filter(F.col("event_type") == "view")


def located_plays(t: DriverTables) -> DataFrame:
    """Plays (view events) with the star schema's songplays columns; location
    is the nation of the user. Join strategies are the planner's: small
    dimension sides are broadcast on their size, large ones shuffled with AQE
    splitting skewed partitions."""
    cust = t.customer.select(F.col("c_custkey").alias("user_id"), "c_nationkey", "c_mktsegment")
    nat = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    v = views(t.events).select("event_id", "user_id", "value")
    return (v.join(cust, "user_id").join(nat, "c_nationkey")
            .select(F.col("event_id").alias("songplay_id"), F.col("event_id").alias("time_id"),
                    F.col("user_id").cast("int").alias("user_id"),
                    F.when(F.col("value") >= 50, F.lit("paid")).otherwise(F.lit("free")).alias("level"),
                    F.when(F.col("user_id") % 9 == 0, F.lit(None).cast("string"))
                    .otherwise(F.col("n_name")).alias("location"),
                    F.col("c_mktsegment").alias("user_agent")))


def plain_plays(events: DataFrame) -> DataFrame:
    """Plays with only their ids and user (no dimension join needed)."""
    return views(events).select(F.col("event_id").alias("songplay_id"),
                                F.col("event_id").alias("time_id"),
                                F.col("user_id").cast("int").alias("user_id"))


def times_of(events: DataFrame) -> DataFrame:
    """times rows of the plays: start_time floored to the second and its parts."""
    v = views(events).select(F.col("event_id").alias("time_id"),
                             floor_to_second("ts").alias("start_time"))
    return v.withColumns(time_part_columns("start_time"))


def plays_with_song_fields(t: DriverTables) -> DataFrame:
    """View events with the (artist, song, length) a log line would carry."""
    p = t.part.select(F.col("p_partkey").alias("event_id"), F.col("p_brand").alias("artist"),
                      F.col("p_name").alias("song"), F.col("p_retailprice").alias("length"))
    return views(t.events).select("event_id", "user_id", "ts").join(p, "event_id", "left")


def log_records_of(t: DriverTables) -> DataFrame:
    """Every event as an activity-log object (epoch-ms ``ts``, text userId,
    empty-string and tab edge cases, one field the ETL does not name)."""
    e = t.events
    k = F.col("c_custkey")
    cust = t.customer.select(F.col("c_custkey").alias("user_id"), "c_custkey", "c_name",
                             "c_nationkey", "c_mktsegment")
    nat = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    p = t.part.select(F.col("p_partkey").alias("event_id"), "p_brand", "p_name", "p_retailprice")
    is_view = F.col("event_type") == "view"
    j = (e.join(cust, "user_id").join(nat, "c_nationkey")
         .join(p, "event_id", "left"))
    return j.select(
        F.col("p_brand").alias("artist"),
        F.lit("Logged In").alias("auth"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("firstName"),
        F.when(k % 2 == 0, F.lit("F")).otherwise(F.lit("M")).alias("gender"),
        F.col("event_id").alias("itemInSession"),
        F.when(k % 11 == 0, F.lit(None).cast("string"))
        .otherwise(F.split_part("c_name", F.lit("#"), F.lit(2))).alias("lastName"),
        F.col("p_retailprice").alias("length"),
        F.when(F.col("value") >= 50, F.lit("paid")).otherwise(F.lit("free")).alias("level"),
        F.when(F.col("user_id") % 9 == 0, F.lit("")).otherwise(F.col("n_name")).alias("location"),
        F.when(is_view, F.lit("NextSong")).otherwise(F.col("event_type")).alias("page"),
        (F.col("event_id") % 1000).cast("int").alias("sessionId"),
        F.col("p_name").alias("song"),
        ntz_to_epoch_ms("ts").alias("ts"),
        F.concat(F.col("c_mktsegment"),
                 F.when(k % 4 == 0, F.lit(TAB + "x")).otherwise(F.lit(""))).alias("userAgent"),
        F.when(~is_view & (F.col("event_id") % 10 == 0), F.lit(""))
        .otherwise(F.col("user_id").cast("string")).alias("userId"))


def write_song_folder(t: DriverTables, root: str) -> str:
    """Song objects as JSON Lines in nested folders; a second copy of some
    songs in another folder, a stray text file and an editor-checkpoint copy
    that must not be read."""
    songs = song_records_of(t.part)
    write_table(songs.withColumn("shelf", F.col("year") % 4), f"{root}/A", fmt="json",
                partition_by=["shelf"])
    write_table(songs.filter(F.col("year") <= 5), f"{root}/B/dup", fmt="json")
    write_table(songs.filter(F.col("year") == 1), f"{root}/.ipynb_checkpoints", fmt="json")
    write_table(songs.filter(F.col("year") == 2).select(F.col("song_id").alias("value")),
                f"{root}/stray", fmt="text")
    return root


def write_log_folder(t: DriverTables, root: str) -> str:
    """Log objects as JSON Lines, one folder per event kind, plus a second
    delivery of the paid-level plays in another folder (removed by the
    distinct)."""
    logs = log_records_of(t)
    write_table(logs.withColumn("kind", F.col("page")), f"{root}/events", fmt="json",
                partition_by=["kind"])
    write_table(logs.filter((F.col("page") == "NextSong") & (F.col("level") == "paid")),
                f"{root}/replay", fmt="json")
    return root
