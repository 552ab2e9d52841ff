"""Declared source schemas and the five star-schema target tables.

Durations are exact decimals because they are an equality key of the song
lookup: a JSON number is read straight into DECIMAL(28,10) and never passes
through a double.
"""

from __future__ import annotations

from pyspark.sql import types as T

DURATION = T.DecimalType(28, 10)

# The source field names, the five target table names and their
# column names below are those of the surveyed system and must stay equal to
# them (``latitude`` is the one deliberate respelling, documented in SURVEY §1.4).

# Song metadata, one JSON object per file (the 9 fields the ETL uses).
SONG_SCHEMA = T.StructType([
    T.StructField("song_id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("artist_id", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("duration", DURATION),
    T.StructField("artist_name", T.StringType()),
    T.StructField("artist_location", T.StringType()),
    T.StructField("artist_latitude", T.DoubleType()),
    T.StructField("artist_longitude", T.DoubleType()),
])

# Activity log, many JSON objects per file (the 13 fields the ETL uses).
# userId is read as text: the app writes it both as number and as string.
LOG_SCHEMA = T.StructType([
    T.StructField("artist", T.StringType()),
    T.StructField("firstName", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("lastName", T.StringType()),
    T.StructField("length", DURATION),
    T.StructField("level", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("page", T.StringType()),
    T.StructField("sessionId", T.IntegerType()),
    T.StructField("song", T.StringType()),
    T.StructField("ts", T.LongType()),
    T.StructField("userAgent", T.StringType()),
    T.StructField("userId", T.StringType()),
])

SONGPLAYS = T.StructType([
    T.StructField("songplay_id", T.LongType(), False),
    T.StructField("time_id", T.LongType(), False),
    T.StructField("user_id", T.IntegerType(), False),
    T.StructField("level", T.StringType()),
    T.StructField("song_id", T.StringType()),
    T.StructField("artist_id", T.StringType()),
    T.StructField("session_id", T.IntegerType()),
    T.StructField("location", T.StringType()),
    T.StructField("user_agent", T.StringType()),
])

USERS = T.StructType([
    T.StructField("user_id", T.IntegerType(), False),
    T.StructField("first_name", T.StringType()),
    T.StructField("last_name", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("level", T.StringType()),
])

TIMES = T.StructType([
    T.StructField("time_id", T.LongType(), False),
    T.StructField("start_time", T.TimestampNTZType(), False),
    T.StructField("hour", T.IntegerType(), False),
    T.StructField("day", T.IntegerType(), False),
    T.StructField("week", T.IntegerType(), False),
    T.StructField("month", T.IntegerType(), False),
    T.StructField("year", T.IntegerType(), False),
    T.StructField("weekday", T.IntegerType(), False),
])

ARTISTS = T.StructType([
    T.StructField("artist_id", T.StringType(), False),
    T.StructField("name", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
])

SONGS = T.StructType([
    T.StructField("song_id", T.StringType(), False),
    T.StructField("title", T.StringType()),
    T.StructField("artist_id", T.StringType(), False),
    T.StructField("year", T.IntegerType()),
    T.StructField("duration", DURATION),
])

TABLES = {
    "songplays": SONGPLAYS,
    "users": USERS,
    "times": TIMES,
    "artists": ARTISTS,
    "songs": SONGS,
}

# Declared constraints of the target tables; enforced by playstats.operators.quality
PRIMARY_KEYS = {
    "songplays": ["songplay_id"],
    "users": ["user_id"],
    "times": ["time_id"],
    "artists": ["artist_id"],
    "songs": ["song_id"],
}
NOT_NULL = {
    "songplays": ["time_id", "user_id"],
    "times": ["start_time", "hour", "day", "week", "month", "year", "weekday"],
    "songs": ["artist_id"],
}
FOREIGN_KEYS = {
    "songplays": [("time_id", "times", "time_id"), ("user_id", "users", "user_id")],
}


def ddl(schema: T.StructType) -> str:
    """Column list usable in ``CREATE TABLE t (<ddl>) USING parquet``."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
