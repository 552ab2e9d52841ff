"""The reports as Spark SQL text over the star tables registered as views,
for users who run their questions as SQL.

``register_star(spark, tables)`` names the five tables (and the song lookup
catalog) as temporary views; the statements below then run with
``spark.sql``. The total for the location percentages is a scalar subquery
instead of a number pasted into the text, ties are broken explicitly, and the
lookup takes named parameters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from playstats.operators.lookup import song_artist_catalog

PLAYS_BY_HOUR = """
SELECT t.hour, COUNT(sp.songplay_id) AS songplays_counter
FROM songplays sp
JOIN times t ON t.time_id = sp.time_id
GROUP BY t.hour
ORDER BY t.hour
"""

PLAYS_BY_LOCATION = """
SELECT sp.location,
       COUNT(sp.songplay_id) AS songplay_counter,
       CAST(COUNT(sp.songplay_id) AS DOUBLE) / (SELECT COUNT(*) FROM songplays) * 100 AS songplays_percent
FROM songplays sp
GROUP BY sp.location
ORDER BY songplay_counter DESC, sp.location ASC NULLS LAST
"""

TOP_USERS = """
WITH per_user AS (
  SELECT user_id, COUNT(user_id) AS songplays_counter FROM songplays GROUP BY user_id
)
SELECT u.user_id, u.first_name || ' ' || u.last_name AS user_fullname, p.songplays_counter
FROM per_user p
JOIN users u ON u.user_id = p.user_id
ORDER BY p.songplays_counter DESC, user_fullname ASC NULLS LAST, u.user_id
"""

SONG_LOOKUP = """
SELECT song_id, artist_id
FROM song_catalog
WHERE name = :artist AND title = :title AND duration = :duration
ORDER BY song_id
LIMIT 1
"""


def register_star(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    """Temporary views ``songplays users times artists songs`` and
    ``song_catalog`` (one row per artist name, title and duration)."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    if "songs" in tables and "artists" in tables:
        song_artist_catalog(tables["songs"], tables["artists"]).createOrReplaceTempView("song_catalog")


def run(spark: SparkSession, statement: str, **params) -> DataFrame:
    return spark.sql(statement, args=params or None)
