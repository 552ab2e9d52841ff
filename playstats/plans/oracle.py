"""DuckDB SQL computing the expected result of each registered query from the
driver's tables (views ``events customer nation part orders lineitem supplier
...``). The derivations repeat ``playstats.plans.analogues`` in SQL.

Conventions: DuckDB date parts are BIGINT and Spark's INT, so parts are cast
to INTEGER; Spark sorts NULL first on ascending order, DuckDB last, so
orderings that may meet NULL say NULLS FIRST/LAST explicitly.
"""

from __future__ import annotations

USERS = """
    SELECT CAST(c_custkey AS INTEGER) AS user_id,
           split_part(c_name, '#', 1) AS first_name,
           CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE split_part(c_name, '#', 2) END AS last_name,
           CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
           CASE WHEN c_acctbal >= 5000 THEN 'paid' ELSE 'free' END AS level
    FROM customer"""

SONGS = """
    SELECT 'S' || lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS song_id, p_name AS title,
           p_brand AS artist_id, p_size AS year, p_retailprice AS duration
    FROM part"""

ARTISTS = """
    SELECT DISTINCT artist_id, name,
           CASE WHEN bn % 5 = 0 THEN '' ELSE 'City ' || CAST(bn AS VARCHAR) END AS location,
           CASE WHEN bn % 3 = 0 THEN NULL ELSE CAST(bn AS DOUBLE) END AS latitude,
           CAST(-bn AS DOUBLE) AS longitude
    FROM (SELECT p_brand AS artist_id, p_brand AS name,
                 CAST(split_part(p_brand, '#', 2) AS INTEGER) AS bn FROM part)"""

CATALOG = f"""
    SELECT a.name, s.title, s.duration, min(s.song_id) AS song_id,
           arg_min(s.artist_id, s.song_id) AS artist_id
    FROM ({SONGS}) s JOIN ({ARTISTS}) a ON a.artist_id = s.artist_id
    WHERE a.name IS NOT NULL AND s.title IS NOT NULL AND s.duration IS NOT NULL
    GROUP BY a.name, s.title, s.duration"""

PLAYS_WITH_SONG_FIELDS = """
    SELECT e.event_id, e.user_id, e.ts, p.p_brand AS artist, p.p_name AS song,
           p.p_retailprice AS length
    FROM events e LEFT JOIN part p ON p.p_partkey = e.event_id
    WHERE e.event_type = 'view'"""

LOOKED_UP = f"""
    SELECT pl.event_id AS songplay_id, c.song_id, c.artist_id
    FROM ({PLAYS_WITH_SONG_FIELDS}) pl
    LEFT JOIN ({CATALOG}) c ON c.name = pl.artist AND c.title = pl.song AND c.duration = pl.length"""

LOCATED_PLAYS = """
    SELECT e.event_id AS songplay_id, e.event_id AS time_id, CAST(e.user_id AS INTEGER) AS user_id,
           CASE WHEN e.value >= 50 THEN 'paid' ELSE 'free' END AS level,
           CASE WHEN e.user_id % 9 = 0 THEN NULL ELSE n.n_name END AS location,
           c.c_mktsegment AS user_agent
    FROM events e JOIN customer c ON c.c_custkey = e.user_id
    JOIN nation n ON n.n_nationkey = c.c_nationkey
    WHERE e.event_type = 'view'"""

PLAIN_PLAYS = """
    SELECT event_id AS songplay_id, event_id AS time_id, CAST(user_id AS INTEGER) AS user_id
    FROM events WHERE event_type = 'view'"""

TIMES = """
    SELECT event_id AS time_id, date_trunc('second', ts) AS start_time,
           CAST(hour(ts) AS INTEGER) AS hour, CAST(day(ts) AS INTEGER) AS day,
           CAST(week(ts) AS INTEGER) AS week, CAST(month(ts) AS INTEGER) AS month,
           CAST(year(ts) AS INTEGER) AS year, CAST(isodow(ts) - 1 AS INTEGER) AS weekday
    FROM events WHERE event_type = 'view'"""

# NextSong log lines after cleaning ('' -> NULL, tab removed, userId -> INT), numbered in
# event-time order with the raw fields as tie-break: the declared fields in schema order,
# then the undeclared ones (sorted key/value text: auth, itemInSession).
CLEAN_PLAYS = """
    SELECT *, row_number() OVER (ORDER BY ts, artist NULLS FIRST, firstName NULLS FIRST,
             gender NULLS FIRST, lastName NULLS FIRST, length NULLS FIRST, level NULLS FIRST,
             raw_location NULLS FIRST, page NULLS FIRST, sessionId NULLS FIRST, song NULLS FIRST,
             raw_userAgent NULLS FIRST, raw_userId NULLS FIRST, raw_auth NULLS FIRST,
             raw_itemInSession NULLS FIRST) - 1 AS songplay_id
    FROM (
      SELECT p.p_brand AS artist, 'Logged In' AS raw_auth,
             split_part(c.c_name, '#', 1) AS firstName,
             CASE WHEN c.c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
             CAST(e.event_id AS VARCHAR) AS raw_itemInSession,
             CASE WHEN c.c_custkey % 11 = 0 THEN NULL ELSE split_part(c.c_name, '#', 2) END AS lastName,
             CAST(p.p_retailprice AS DECIMAL(28,10)) AS length,
             CASE WHEN e.value >= 50 THEN 'paid' ELSE 'free' END AS level,
             CASE WHEN e.user_id % 9 = 0 THEN '' ELSE n.n_name END AS raw_location,
             CASE WHEN e.user_id % 9 = 0 THEN NULL ELSE n.n_name END AS location,
             'NextSong' AS page,
             CAST(e.event_id % 1000 AS INTEGER) AS sessionId,
             p.p_name AS song,
             epoch_ms(e.ts) AS ts,
             e.ts AS event_ts,
             c.c_mktsegment || CASE WHEN c.c_custkey % 4 = 0 THEN chr(9) || 'x' ELSE '' END AS raw_userAgent,
             c.c_mktsegment || CASE WHEN c.c_custkey % 4 = 0 THEN 'x' ELSE '' END AS userAgent,
             CAST(e.user_id AS VARCHAR) AS raw_userId,
             CAST(e.user_id AS INTEGER) AS userId
      FROM events e JOIN customer c ON c.c_custkey = e.user_id
      JOIN nation n ON n.n_nationkey = c.c_nationkey
      LEFT JOIN part p ON p.p_partkey = e.event_id
      WHERE e.event_type = 'view')"""

JSON_CATALOG = f"""
    SELECT a.name, s.title, s.duration, min(s.song_id) AS song_id,
           arg_min(s.artist_id, s.song_id) AS artist_id
    FROM (SELECT song_id, title, artist_id, CAST(duration AS DECIMAL(28,10)) AS duration
          FROM ({SONGS})) s
    JOIN ({ARTISTS}) a ON a.artist_id = s.artist_id
    WHERE a.name IS NOT NULL AND s.title IS NOT NULL AND s.duration IS NOT NULL
    GROUP BY a.name, s.title, s.duration"""

DML_INPUTS = f"""
    u AS ({USERS}),
    t AS (SELECT CAST(CASE WHEN level = 'free' THEN user_id ELSE user_id + 1000000000 END AS INTEGER) AS user_id,
                 first_name, last_name, gender, level FROM u),
    b AS (SELECT u.user_id, CASE WHEN e.event_id % 2 = 0 THEN 'Even' ELSE 'Odd' END AS first_name,
                 u.last_name, u.gender, e.event_type AS level, e.ts, e.event_id
          FROM events e JOIN u ON e.user_id = u.user_id),
    r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rf,
                    row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rl
          FROM b),
    bf AS (SELECT * FROM r WHERE rf = 1),
    bl AS (SELECT * FROM r WHERE rl = 1)"""

DIRTY_CUSTOMERS = """
    SELECT c_custkey,
           CASE WHEN c_custkey % 7 = 0 THEN c_name || chr(9) || 'tab'
                WHEN c_custkey % 7 = 1 THEN c_name || '"quoted"'
                WHEN c_custkey % 7 = 2 THEN c_name || ',comma'
                WHEN c_custkey % 7 = 3 THEN c_name || '\\back'
                WHEN c_custkey % 7 = 4 THEN ''
                WHEN c_custkey % 7 = 5 THEN {null_text}
                WHEN c_custkey % 3 = 0 THEN ' ' || chr(10) || c_name || chr(13) || chr(10) || chr(92) || 'n '
                WHEN c_custkey % 3 = 1 THEN chr(1)
                ELSE chr(92) || 'N' END AS c_name,
           c_acctbal,
           CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment
    FROM customer"""


def _union_counts(table: str, cols: list[str], expr: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, {expr.format(c=c)} FROM {table}" for c in cols)


ORACLE_SQL: dict[str, str] = {
    # scans, projections, filters
    "scan_table": "SELECT * FROM customer",
    "project_columns": "SELECT user_id, event_type, ts FROM events",
    "project_rename": """SELECT c_custkey AS user_id, c_name AS user_name, c_nationkey AS nation_id,
                                c_acctbal, c_mktsegment FROM customer""",
    "project_drop": "SELECT event_id, ts, user_id, event_type, value FROM events",
    "filter_page": """
        SELECT event_id, user_id, page FROM (
          SELECT event_id, user_id,
                 CASE WHEN user_id % 7 = 0 THEN NULL WHEN event_type = 'view' THEN 'NextSong'
                      ELSE event_type END AS page
          FROM events) WHERE page = 'NextSong'""",
    "filter_point": "SELECT * FROM customer WHERE c_custkey = 42",
    "filter_cast_eq": "SELECT * FROM events WHERE CAST(user_id AS VARCHAR) = '88'",
    "filter_not_null": f"SELECT * FROM ({LOOKED_UP}) WHERE song_id IS NOT NULL",
    "full_name": f"SELECT user_id, first_name || ' ' || last_name AS user_fullname FROM ({USERS})",

    # file sources and sinks
    "scan_json_lines": "SELECT DISTINCT * FROM events",
    "scan_with_filename": "SELECT event_id, 'kind=' || event_type AS folder FROM events",
    "scan_file_listing": "SELECT DISTINCT 'kind=' || event_type AS folder FROM events UNION SELECT 'nested'",
    "tsv_round_trip": DIRTY_CUSTOMERS.format(null_text="NULL"),
    "csv_round_trip": DIRTY_CUSTOMERS.format(null_text="'NULL'"),
    "write_read_table": SONGS,
    "insert_rows": USERS,

    # cleaning and time
    "time_parts": """
        SELECT event_id, date_trunc('second', ts) AS start_time,
               CAST(hour(ts) AS INTEGER) AS hour, CAST(day(ts) AS INTEGER) AS day,
               CAST(week(ts) AS INTEGER) AS week, CAST(month(ts) AS INTEGER) AS month,
               CAST(year(ts) AS INTEGER) AS year, CAST(isodow(ts) - 1 AS INTEGER) AS weekday
        FROM events""",
    "clean_frame": """
        WITH d AS (
          SELECT event_id, event_type,
                 CASE event_id % 10 WHEN 0 THEN '' WHEN 1 THEN chr(9) WHEN 2 THEN 'a' || chr(9) || 'b'
                      WHEN 3 THEN NULL WHEN 4 THEN 'NULL' ELSE props END AS props,
                 CASE WHEN event_id % 13 = 0 THEN CAST('NaN' AS DOUBLE) ELSE value END AS value
          FROM events)
        SELECT event_id, replace(nullif(event_type, ''), chr(9), '') AS event_type,
               replace(nullif(props, ''), chr(9), '') AS props,
               CASE WHEN isnan(value) THEN NULL ELSE value END AS value
        FROM d""",
    "to_number": """
        WITH d AS (
          SELECT event_id, CASE WHEN event_id % 17 = 0 THEN '' WHEN event_id % 19 = 0 THEN 'abc'
                                ELSE CAST(user_id AS VARCHAR) END AS user_id
          FROM events)
        SELECT event_id, TRY_CAST(user_id AS INTEGER) AS user_id,
               user_id IS NOT NULL AND TRY_CAST(user_id AS INTEGER) IS NULL AS rejected FROM d""",

    # distinct, duplicates, keys
    "distinct_rows": "SELECT DISTINCT o_orderstatus, o_orderdate, o_orderpriority FROM orders",
    "distinct_stored": "SELECT DISTINCT * FROM orders",
    "distinct_projection": "SELECT DISTINCT p_brand, p_type FROM part",
    "dup_rows_all": """
        SELECT o_orderdate, o_orderstatus FROM (
          SELECT o_orderdate, o_orderstatus,
                 count(*) OVER (PARTITION BY o_orderdate, o_orderstatus) AS c FROM orders)
        WHERE c > 1""",
    "dup_rows_subset": """
        SELECT o_orderkey, o_custkey, o_orderdate, o_orderstatus FROM (
          SELECT *, count(*) OVER (PARTITION BY o_orderdate, o_orderstatus) AS c FROM orders)
        WHERE c > 1""",
    "dup_count": """
        SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_distinct,
               CAST(sum(n - 1) AS BIGINT) AS n_duplicates
        FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderdate, o_orderstatus)""",
    "groups_larger_than": """
        SELECT o_orderkey, o_orderdate FROM (
          SELECT o_orderkey, o_orderdate, count(*) OVER (PARTITION BY o_orderdate) AS c FROM orders)
        WHERE c > 8""",
    "key_cardinality": """
        WITH d AS (SELECT CASE WHEN user_id % 10 = 3 THEN NULL ELSE user_id END AS user_id FROM events)
        SELECT count(*) AS n_rows, count(user_id) AS n_non_null,
               count(DISTINCT user_id) AS n_distinct,
               count(DISTINCT user_id) + max(CASE WHEN user_id IS NULL THEN 1 ELSE 0 END) AS n_unique
        FROM d""",
    "dedup_keep_last": """
        SELECT user_id, event_type, ts, event_id FROM (
          SELECT user_id, event_type, ts, event_id,
                 row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
          FROM events) WHERE rn = 1""",
    "surrogate_id": """
        SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS songplay_id
        FROM events WHERE event_type = 'view'""",
    "surrogate_id_continued": """
        SELECT event_id, row_number() OVER (ORDER BY event_id % 2, ts, event_id) - 1 AS songplay_id
        FROM events WHERE event_type = 'view'""",
    "scan_new_files": "SELECT * FROM events WHERE event_type = 'view'",
    "patch_by_key": f"""
        WITH pl AS ({PLAYS_WITH_SONG_FIELDS}),
             pa AS (SELECT p_partkey + 3 AS event_id, p_brand AS artist, p_name AS song,
                           p_retailprice AS length FROM part WHERE p_size <= 10
                    UNION ALL SELECT -p_partkey, p_brand, p_name, p_retailprice FROM part WHERE p_size > 10)
        SELECT pl.event_id,
               CASE WHEN pa.event_id IS NOT NULL THEN pa.artist ELSE pl.artist END AS artist,
               CASE WHEN pa.event_id IS NOT NULL THEN pa.song ELSE pl.song END AS song,
               CASE WHEN pa.event_id IS NOT NULL THEN pa.length ELSE pl.length END AS length
        FROM pl LEFT JOIN pa ON pa.event_id = pl.event_id""",

    # joins and lookup
    "join_songs_artists": f"""
        SELECT s.artist_id, s.song_id, s.title, s.year, s.duration, a.name
        FROM ({SONGS}) s JOIN ({ARTISTS}) a ON a.artist_id = s.artist_id""",
    "lookup_song_artist": LOOKED_UP,
    "lookup_point": f"""
        SELECT song_id, artist_id FROM ({CATALOG})
        WHERE name = 'Brand#2' AND title = 'small ring' AND duration = 900.0
        ORDER BY song_id LIMIT 1""",

    # star-schema builds from JSON folders
    "etl_songs": f"""
        SELECT song_id, title, artist_id, year, CAST(duration AS DECIMAL(28,10)) AS duration
        FROM ({SONGS})""",
    "etl_artists": f"""
        SELECT artist_id, name, nullif(location, '') AS location, latitude, longitude
        FROM ({ARTISTS})""",
    "etl_times": f"""
        SELECT songplay_id AS time_id, date_trunc('second', event_ts) AS start_time,
               CAST(hour(event_ts) AS INTEGER) AS hour, CAST(day(event_ts) AS INTEGER) AS day,
               CAST(week(event_ts) AS INTEGER) AS week, CAST(month(event_ts) AS INTEGER) AS month,
               CAST(year(event_ts) AS INTEGER) AS year,
               CAST(isodow(event_ts) - 1 AS INTEGER) AS weekday
        FROM ({CLEAN_PLAYS})""",
    "etl_users": f"""
        SELECT userId AS user_id, firstName AS first_name, lastName AS last_name, gender, level
        FROM (SELECT *, row_number() OVER (PARTITION BY userId ORDER BY ts DESC, songplay_id DESC) AS rn
              FROM ({CLEAN_PLAYS}))
        WHERE rn = 1""",
    "etl_songplays": f"""
        SELECT p.songplay_id, p.songplay_id AS time_id, p.userId AS user_id, p.level,
               c.song_id, c.artist_id, p.sessionId AS session_id, p.location,
               p.userAgent AS user_agent
        FROM ({CLEAN_PLAYS}) p
        LEFT JOIN ({JSON_CATALOG}) c
          ON c.name = p.artist AND c.title = p.song AND c.duration = p.length""",

    "etl_pipeline": (_RUN_FACTS := f"""
        WITH p AS ({CLEAN_PLAYS})
        SELECT 'hour' AS item, CAST(hour(event_ts) AS VARCHAR) AS name, count(*) AS n FROM p GROUP BY 2
        UNION ALL SELECT 'rows', 'songplays', count(*) FROM p
        UNION ALL SELECT 'rows', 'times', count(*) FROM p
        UNION ALL SELECT 'rows', 'users', count(DISTINCT userId) FROM p
        UNION ALL SELECT 'rows', 'artists', count(*) FROM ({ARTISTS})
        UNION ALL SELECT 'rows', 'songs', count(*) FROM part"""),
    "etl_increment": _RUN_FACTS,
    "count_stored": " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {n}"
                                       for n in ("customer", "events", "part")),

    # reports
    "report_by_hour_stored": f"""
        SELECT t.hour, count(sp.songplay_id) AS songplays_counter
        FROM ({PLAIN_PLAYS}) sp JOIN ({TIMES}) t ON t.time_id = sp.time_id
        GROUP BY t.hour""",
    "report_by_hour": f"""
        SELECT t.hour, count(sp.songplay_id) AS songplays_counter
        FROM ({PLAIN_PLAYS}) sp JOIN ({TIMES}) t ON t.time_id = sp.time_id
        GROUP BY t.hour""",
    "report_by_location": f"""
        WITH sp AS ({LOCATED_PLAYS})
        SELECT location, count(songplay_id) AS songplay_counter,
               round(CAST(count(songplay_id) AS DOUBLE) / (SELECT count(*) FROM sp) * 100, 6)
                 AS songplays_percent
        FROM sp GROUP BY location""",
    "report_top_users": f"""
        SELECT u.user_id, u.first_name || ' ' || u.last_name AS user_fullname,
               count(sp.user_id) AS songplays_counter
        FROM ({PLAIN_PLAYS}) sp JOIN ({USERS}) u ON u.user_id = sp.user_id
        GROUP BY u.user_id, u.first_name, u.last_name""",
    "count_by_user": f"""
        SELECT u.user_id, count(sp.user_id) AS songplays_counter
        FROM ({USERS}) u JOIN ({PLAIN_PLAYS}) sp ON u.user_id = sp.user_id
        GROUP BY u.user_id""",
    "count_total": f"SELECT count(*) AS total_songplays FROM ({PLAIN_PLAYS})",
    "topk_users": f"""
        SELECT u.user_id, u.first_name || ' ' || u.last_name AS user_fullname,
               count(sp.user_id) AS songplays_counter
        FROM ({PLAIN_PLAYS}) sp JOIN ({USERS}) u ON u.user_id = sp.user_id
        GROUP BY u.user_id, u.first_name, u.last_name
        ORDER BY songplays_counter DESC, user_fullname ASC NULLS LAST, u.user_id
        LIMIT 10""",
    "topk_locations": f"""
        SELECT location, count(songplay_id) AS songplay_counter FROM ({LOCATED_PLAYS})
        GROUP BY location ORDER BY songplay_counter DESC, location ASC NULLS LAST LIMIT 10""",
    "topk_share": f"""
        WITH top AS (
          SELECT location, count(songplay_id) AS songplay_counter FROM ({LOCATED_PLAYS})
          GROUP BY location ORDER BY songplay_counter DESC, location ASC NULLS LAST LIMIT 10)
        SELECT location, songplay_counter,
               CAST(round_even(CAST(songplay_counter AS DOUBLE) * 100.0
                               / CAST(sum(songplay_counter) OVER () AS DOUBLE), 0) AS INTEGER)
                 AS share_percent
        FROM top""",
    "limit_n": f"SELECT * FROM ({LOCATED_PLAYS}) ORDER BY songplay_id LIMIT 5",
    "head_tail": """
        (SELECT * FROM events ORDER BY event_id LIMIT 3)
        UNION ALL
        (SELECT * FROM events ORDER BY event_id DESC LIMIT 3)""",
    "slice_rows": "SELECT * FROM events ORDER BY ts, event_id LIMIT 10 OFFSET 3",

    # DML
    "upsert_level": f"""
        WITH {DML_INPUTS}
        SELECT coalesce(t.user_id, bf.user_id) AS user_id,
               CASE WHEN t.user_id IS NOT NULL THEN t.first_name ELSE bf.first_name END AS first_name,
               CASE WHEN t.user_id IS NOT NULL THEN t.last_name ELSE bf.last_name END AS last_name,
               CASE WHEN t.user_id IS NOT NULL THEN t.gender ELSE bf.gender END AS gender,
               CASE WHEN bl.user_id IS NOT NULL THEN bl.level ELSE t.level END AS level
        FROM t FULL OUTER JOIN bf ON bf.user_id = t.user_id
        LEFT JOIN bl ON bl.user_id = coalesce(t.user_id, bf.user_id)""",
    "insert_if_absent": f"""
        WITH {DML_INPUTS}
        SELECT user_id, first_name, last_name, gender, level FROM t
        UNION ALL
        SELECT user_id, first_name, last_name, gender, level FROM bf
        WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.user_id = bf.user_id)""",
    "delete_by_key": f"""
        SELECT * FROM ({USERS}) u
        WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.event_type = 'error' AND e.value > 90
                          AND e.user_id = u.user_id)""",

    # quality checks
    "check_primary_key": """
        SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
        GROUP BY l_orderkey, l_linenumber
        HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL""",
    "check_foreign_key": """
        SELECT l_partkey, count(*) AS n_rows FROM lineitem l
        WHERE l_partkey IS NOT NULL
          AND NOT EXISTS (SELECT 1 FROM part p
                          WHERE CASE WHEN p.p_size > 5 THEN p.p_partkey ELSE -p.p_partkey END = l.l_partkey)
        GROUP BY l_partkey""",
    "check_not_null": f"""
        WITH u AS ({USERS})
        {_union_counts('u', ['user_id', 'first_name', 'last_name', 'gender', 'level'],
                       'count(*) FILTER (WHERE {c} IS NULL) AS null_count')}""",
    "check_row_counts": """
        SELECT 'orders' AS table_name, count(*) AS expected_rows, count(*) AS loaded_rows, true AS ok
        FROM orders""",
    "check_rows_per_file": """SELECT count(*) AS n_rows, count(DISTINCT p_brand) AS n_files,
                                     count(*) = count(DISTINCT p_brand) AS ok FROM part""",

    # profiles
    "profile_text": """
        WITH v AS (SELECT 'o_orderstatus' AS column_name, o_orderstatus AS value FROM orders
                   UNION ALL SELECT 'o_orderpriority', o_orderpriority FROM orders),
             f AS (SELECT column_name, value, count(*) AS n FROM v WHERE value IS NOT NULL GROUP BY 1, 2),
             r AS (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS rk
                   FROM f)
        SELECT column_name, CAST(sum(n) AS BIGINT) AS "count", count(*) AS "unique",
               max(CASE WHEN rk = 1 THEN value END) AS top, max(n) AS freq
        FROM r GROUP BY column_name""",
    "profile_numeric": """
        WITH v AS (SELECT 'l_quantity' AS column_name, CAST(l_quantity AS DOUBLE) AS value FROM lineitem
                   UNION ALL SELECT 'l_discount', CASE WHEN l_linenumber = 2 THEN NULL
                                    ELSE CAST(l_discount AS DOUBLE) END FROM lineitem
                   UNION ALL SELECT 'l_tax', CAST(l_tax AS DOUBLE) FROM lineitem)
        SELECT column_name, count(value) AS "count", round(avg(value), 6) AS mean,
               round(stddev_samp(value), 6) AS std, round(min(value), 6) AS "min",
               round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS p50,
               round(quantile_cont(value, 0.75), 6) AS p75, round(max(value), 6) AS "max"
        FROM v GROUP BY column_name""",
    "profile_timestamp": """
        WITH f AS (SELECT o_orderdate AS value, count(*) AS n FROM orders
                   WHERE o_orderdate IS NOT NULL GROUP BY 1),
             r AS (SELECT *, row_number() OVER (ORDER BY n DESC, value) AS rk FROM f)
        SELECT 'o_orderdate' AS column_name, CAST(sum(n) AS BIGINT) AS "count", count(*) AS "unique",
               max(CASE WHEN rk = 1 THEN value END) AS top, max(n) AS freq,
               min(value) AS "first", max(value) AS "last"
        FROM r""",
    "profile_dtypes": """
        SELECT 'event_id' AS column_name, 'bigint' AS data_type, count(event_id) AS non_null FROM events
        UNION ALL SELECT 'ts', 'timestamp_ntz', count(ts) FROM events
        UNION ALL SELECT 'user_id', 'bigint', count(user_id) FROM events
        UNION ALL SELECT 'event_type', 'string', count(event_type) FROM events
        UNION ALL SELECT 'value', 'double', count(value) FROM events
        UNION ALL SELECT 'props', 'string', count(props) FROM events""",

    # catalog: the query stores three tables derived from the data and lists them
    "catalog_tables": f"""
        SELECT 'artists' AS table_name, count(*) AS n_rows FROM ({ARTISTS})
        UNION ALL SELECT 'songs', count(*) FROM part UNION ALL SELECT 'users', count(*) FROM customer""",

    # set operations
    "union_by_name": """
        SELECT s_suppkey AS key, s_name AS name, s_nationkey AS nationkey, s_acctbal AS acctbal
        FROM supplier
        UNION ALL BY NAME
        SELECT c_custkey AS key, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal,
               c_mktsegment AS mktsegment
        FROM customer""",
}
