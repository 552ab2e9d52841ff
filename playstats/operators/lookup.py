"""Entity lookup: resolve each play to (song_id, artist_id) by
(artist name, song title, duration).

One set-wise left join replaces a query per play. The catalog is reduced to one
row per lookup key first (smallest song_id on ties), so the join never adds
rows, and keys that contain NULL are dropped from it because ``=`` never matches
NULL. Most plays of a log have no entry in the catalog: a Bloom filter of its keys
(``operators.bloom``) keeps them out of the shuffle. Songs and artists with very
many rows are spread over several tasks (``operators.joins``); whether a side is
broadcast is the planner's choice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playstats.operators.bloom import MAX_BYTES, BloomFilter
from playstats.operators.joins import ROWS_PER_BUCKET, planner_broadcasts, skew_safe_join
from playstats.scratch import stored

CATALOG_KEYS = ("name", "title", "duration")


def join_songs_artists(songs: DataFrame, artists: DataFrame) -> DataFrame:
    """songs ⋈ artists on artist_id (inner); an artist of very many songs is spread
    over several tasks. Artists may be repeated under several spellings."""
    a = artists.select("artist_id", "name").dropDuplicates()
    j = skew_safe_join(songs, a, ["artist_id"], "inner")
    return j.select("artist_id", *[F.col(f"`{c}`") for c in songs.columns if c != "artist_id"], "name")


def song_artist_catalog(songs: DataFrame, artists: DataFrame) -> DataFrame:
    """(name, title, duration) -> one (song_id, artist_id)."""
    j = (join_songs_artists(songs.select("song_id", "title", "artist_id", "duration"), artists)
         .filter(F.col("name").isNotNull() & F.col("title").isNotNull()
                 & F.col("duration").isNotNull()))
    return (j.groupBy(*CATALOG_KEYS)
            .agg(F.min(F.struct("song_id", "artist_id")).alias("_m"))
            .select(*CATALOG_KEYS, F.col("_m.song_id").alias("song_id"),
                    F.col("_m.artist_id").alias("artist_id")))


def lookup_song_artist(plays: DataFrame, catalog: DataFrame, artist_col: str = "artist",
                       title_col: str = "song", length_col: str = "length",
                       song_id_col: str = "song_id", artist_id_col: str = "artist_id",
                       rows_per_bucket: int = ROWS_PER_BUCKET, filter_bytes: int = MAX_BYTES) -> DataFrame:
    """Left join every play to the catalog; unmatched plays get NULL ids.

    A catalog that the planner broadcasts (by its size) is joined as it is. Beyond
    that, a Bloom filter of its keys, of ``filter_bytes`` at most, first parts the plays:
    those that it refuses have no song and go on without a shuffle, and only the others
    are joined. The same song may account for a large share of them, so that join is
    :func:`playstats.operators.joins.skew_safe_join`: a song with more than
    ``rows_per_bucket`` plays is spread over tasks in proportion to its size."""
    keys = [artist_col, title_col, length_col]
    c = catalog.select(F.col("name").alias(artist_col), F.col("title").alias(title_col),
                       F.col("duration").alias(length_col),
                       F.col("song_id").alias(song_id_col), F.col("artist_id").alias(artist_id_col))
    c = stored(c, "catalog")  # read three times at most; its size and rows are known from now on
    p = plays.drop(song_id_col, artist_id_col)
    columns = [*[F.col(f"`{x}`") for x in p.columns], song_id_col, artist_id_col]
    if planner_broadcasts(c):
        return p.join(c, keys, "left").select(*columns)
    known = BloomFilter.of(c, keys, filter_bytes)
    if known is None:
        return skew_safe_join(p, c, keys, "left", rows_per_bucket=rows_per_bucket).select(*columns)
    held = known.might_hold(p, keys)  # never NULL
    refused = p.filter(~held).select("*", *[F.lit(None).cast(c.schema[x].dataType).alias(x) for x in (song_id_col, artist_id_col)])
    joined = skew_safe_join(p.filter(held), c, keys, "left", rows_per_bucket=rows_per_bucket)
    return joined.select(*columns).unionByName(refused.select(*columns))


def lookup_point(catalog: DataFrame, artist: str, title: str, duration) -> DataFrame:
    """The single catalog entry for one (artist, title, duration), as a named-
    parameter SQL query; at most one row (smallest song_id)."""
    spark = catalog.sparkSession
    return spark.sql(
        "SELECT song_id, artist_id FROM {catalog} "
        "WHERE name = :artist AND title = :title AND duration = :duration "
        "ORDER BY song_id LIMIT 1",
        args={"artist": artist, "title": title, "duration": duration},
        catalog=catalog)
