"""The play reports: peak hours, most active users, plays by location.

Every report aggregates with partial (map-side) counts, so a hot hour, user or
location costs one small row per task before the shuffle. Only the ordered,
bounded results (24 hours, top-k) are meant for the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playstats.functions.text import full_name
from playstats.operators.ordering import share_percent, top_k
from playstats.scratch import stored

# The report output column names below (hour, songplays_counter,
# location, songplay_counter, songplays_percent, user_id, user_fullname) are
# those of the surveyed system's three reports and must stay equal to them.


def plays_by_hour(songplays: DataFrame, times: DataFrame) -> DataFrame:
    """Plays per hour of day (only hours that have plays), by hour."""
    j = songplays.select("songplay_id", "time_id").join(times.select("time_id", "hour"), "time_id")
    return (j.groupBy("hour").agg(F.count("songplay_id").alias("songplays_counter"))
            .orderBy("hour"))


def total_plays(songplays: DataFrame) -> DataFrame:
    return songplays.agg(F.count(F.lit(1)).alias("total_songplays"))


def plays_by_location(songplays: DataFrame, total: int | Column | None = None) -> DataFrame:
    """Plays per location (NULL location is its own group) and their percent of
    ``total`` (default: all plays). The default total is a scalar subquery over the
    stored counts per location: the plays are read once, the total is a sum of one
    number per task, and no task sees all locations."""
    counts = songplays.groupBy("location").agg(F.count("songplay_id").alias("songplay_counter"),
                                               F.count(F.lit(1)).alias("_rows"))
    if total is None:
        counts = stored(counts, "location-counts")
        total = counts.agg(F.sum("_rows")).scalar()
    elif not isinstance(total, Column):
        total = F.lit(total)
    return (counts.select("location", "songplay_counter",
                          (F.col("songplay_counter").cast("double") / total.cast("double") * 100.0)
                          .alias("songplays_percent"))
            .orderBy(F.desc("songplay_counter"), F.asc_nulls_last("location")))


def plays_per_user(songplays: DataFrame, users: DataFrame) -> DataFrame:
    """users ⋈ songplays, play count per user. The fact is counted per user_id
    first and then joined with the users dimension (one row per user_id, its
    primary key), so the join moves one row per user instead of one per play."""
    per_user = songplays.groupBy("user_id").agg(F.count("user_id").alias("songplays_counter"))
    return users.select("user_id").join(per_user, "user_id")


def top_users(songplays: DataFrame, users: DataFrame) -> DataFrame:
    """Most active users: id, full name, plays; by plays desc, name asc (NULL
    names last)."""
    per_user = songplays.groupBy("user_id").agg(F.count("user_id").alias("songplays_counter"))
    u = users.select("user_id", full_name("first_name", "last_name").alias("user_fullname"))
    return (u.join(per_user, "user_id")
            .select("user_id", "user_fullname", "songplays_counter")
            .orderBy(F.desc("songplays_counter"), F.asc_nulls_last("user_fullname"), F.asc("user_id")))


def top_k_users(songplays: DataFrame, users: DataFrame, k: int = 10) -> DataFrame:
    return top_k(top_users(songplays, users), k,
                 [F.desc("songplays_counter"), F.asc_nulls_last("user_fullname"), F.asc("user_id")])


def top_k_locations(songplays: DataFrame, k: int = 10) -> DataFrame:
    counts = songplays.groupBy("location").agg(F.count("songplay_id").alias("songplay_counter"))
    return top_k(counts, k, [F.desc("songplay_counter"), F.asc_nulls_last("location")])


def top_k_location_share(songplays: DataFrame, k: int = 10) -> DataFrame:
    """Top-k locations with their integer percent inside the top-k (pie labels)."""
    return share_percent(top_k_locations(songplays, k), "songplay_counter")
