"""Command line: build the star schema, then print the reports.

    python -m playstats reset DATABASE ROOT
    python -m playstats etl SONG_DIR LOG_DIR OUT_DIR [--database DB --buckets N]
    python -m playstats report OUT_DIR [--top 10]
    python -m playstats profile OUT_DIR
    python -m playstats vacuum OUT_DIR [--keep 2] [--older-than-hours 24]

``reset`` drops and recreates the database with the five empty star tables
(stored under ROOT). ``etl`` runs the whole load (constraints checked) and
prints each table's row count. ``report`` prints the plays per hour, the top users and the top
locations with their share. ``profile`` prints describe-style profiles of
every stored table, one row per column. ``vacuum`` removes the files of older
versions. Only these bounded results reach the driver.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession


def _session() -> SparkSession:
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    from playstats.session import get_spark
    return get_spark("playstats-cli")


def _print(title: str, df) -> None:
    print(f"== {title}")
    cols = df.columns
    for row in df.collect():  # bounded: 24 hours or a top-k
        print("  " + " | ".join(f"{c}={row[c]}" for c in cols))


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="python -m playstats")
    sub = ap.add_subparsers(dest="cmd", required=True)
    reset = sub.add_parser("reset", help="drop and recreate the database and the five star tables")
    reset.add_argument("database")
    reset.add_argument("root")
    etl = sub.add_parser("etl", help="JSON folders -> five Parquet tables")
    etl.add_argument("song_dir")
    etl.add_argument("log_dir")
    etl.add_argument("out_dir")
    etl.add_argument("--database")
    etl.add_argument("--buckets", type=int)
    etl.add_argument("--checks", choices=["full", "none"], default="full")
    etl.add_argument("--on-conflict", choices=["error", "quarantine"], default="error",
                     help="several rows for one song or artist id: stop, or set them aside with counts")
    etl.add_argument("--on-bad", choices=["fail", "quarantine"], default="fail",
                     help="malformed source lines: stop, or set them aside with counts")
    rep = sub.add_parser("report", help="plays per hour, top users, top locations")
    rep.add_argument("out_dir")
    rep.add_argument("--top", type=int, default=10)
    prof = sub.add_parser("profile", help="describe-style profile of every stored table")
    prof.add_argument("out_dir")
    vac = sub.add_parser("vacuum", help="remove the files of all but the last versions")
    vac.add_argument("out_dir")
    vac.add_argument("--keep", type=int, default=2)
    vac.add_argument("--older-than-hours", type=float, default=24.0)
    args = ap.parse_args(argv)

    from playstats.plans import reports, star

    spark = _session()
    if args.cmd == "reset":
        from playstats.plans import catalog

        catalog.reset_warehouse(spark, args.database, args.root.rstrip("/"))
        _print(f"tables in {args.database}", catalog.list_tables(spark, args.database))
        return 0
    if args.cmd == "etl":
        tables = star.run_pipeline(spark, args.song_dir, args.log_dir, args.out_dir,
                                   check=args.checks == "full", database=args.database, buckets=args.buckets,
                                   on_conflict=args.on_conflict, on_bad=args.on_bad)
        for name, df in tables.items():
            print(f"{name}: {df.count()} rows")
        return 0
    from playstats.sinks.versioned import VersionedTables

    store = VersionedTables(spark, args.out_dir)
    if args.cmd == "vacuum":
        print(f"{len(store.vacuum(args.keep, args.older_than_hours))} folders removed")
        return 0
    tables = store.tables()
    if args.cmd == "profile":
        from playstats.operators import profile
        from pyspark.sql import types as T

        for name in ("songplays", "users", "times", "artists", "songs"):
            df = tables[name]
            _print(f"{name}: column types", profile.profile_dtypes(df))
            nums = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
            texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
            if nums:
                _print(f"{name}: numbers", profile.profile_numeric(df, nums))
            if texts:
                _print(f"{name}: text", profile.profile_text(df, texts))
        return 0
    t = tables
    _print("plays per hour", reports.plays_by_hour(t["songplays"], t["times"]))
    _print(f"top {args.top} users", reports.top_k_users(t["songplays"], t["users"], args.top))
    _print(f"top {args.top} locations", reports.top_k_location_share(t["songplays"], args.top))
    return 0


if __name__ == "__main__":
    sys.exit(main())
