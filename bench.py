"""Benchmark the headline queries and print ONE JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is run once to warm up, then ``BENCH_RUNS`` times (default 5); the
median wall time of a full evaluation (forced through the ``noop`` sink, so no
rows reach the driver) is reported per query, and ``value`` is their sum.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["report_by_hour", "report_by_location", "report_top_users", "topk_users",
            "lookup_song_artist", "dedup_keep_last", "surrogate_id", "upsert_level",
            "profile_numeric", "groups_larger_than", "etl_pipeline"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))

    from playstats.plans.registry import QUERIES
    from playstats.session import get_spark

    spark = get_spark("playstats-bench", cpus=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    timings: dict[str, float | None] = {}
    errors: dict[str, str] = {}
    for key in HEADLINE:
        build = QUERIES[key]
        samples = []
        try:
            for i in range(runs + 1):
                t0 = time.perf_counter()
                build(spark, sf_dir).write.format("noop").mode("overwrite").save()
                if i:  # first run is the warm-up
                    samples.append(time.perf_counter() - t0)
            timings[key] = round(statistics.median(samples), 4)
        except Exception as exc:  # keep measuring the others; report the failure
            timings[key] = None
            errors[key] = f"{type(exc).__name__}: {str(exc)[:300]}"
    spark.stop()
    sf = sf_dir.rsplit("sf", 1)[-1]
    out = {"metric": "headline_queries_median_sum",
           "value": round(sum(v for v in timings.values() if v is not None), 4),
           "unit": "sec", "queries": timings,
           "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))


if __name__ == "__main__":
    main()
