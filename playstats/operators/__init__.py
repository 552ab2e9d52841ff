from playstats.operators.joins import hot_keys, skew_safe_join
from playstats.operators.keys import (assign_surrogate_id, distinct_projection, distinct_rows,
                                     distinct_stored, duplicate_members, duplicate_summary, expand_counts,
                                     groups_larger_than, keep_first, keep_last, number_sorted_partitions,
                                     patch_by_key)
from playstats.operators.lookup import (join_songs_artists, lookup_point, lookup_song_artist,
                                       song_artist_catalog)
from playstats.operators.ordering import (head, head_tail, limit_n, share_percent, slice_rows, tail,
                                         top_k)

__all__ = [
    "hot_keys", "skew_safe_join", "expand_counts", "number_sorted_partitions",
    "assign_surrogate_id", "distinct_projection", "distinct_rows", "distinct_stored", "duplicate_members",
    "duplicate_summary", "groups_larger_than", "keep_first", "keep_last", "patch_by_key",
    "join_songs_artists", "lookup_point", "lookup_song_artist", "song_artist_catalog",
    "head", "head_tail", "limit_n", "share_percent", "slice_rows", "tail", "top_k",
]
