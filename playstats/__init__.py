"""playstats: music play-log analytics on Spark DataFrames.

Reads JSON Lines song metadata and activity logs, cleans and de-duplicates them,
derives time parts, assigns stable surrogate ids, resolves plays to songs and
artists, builds a star schema (songplays fact; users, times, songs, artists
dimensions) and answers the play reports. Every operator takes and returns
DataFrames; nothing is collected to the driver except bounded, tiny results.
"""

__version__ = "0.1.0"
