"""Plan-level guarantees for the registered queries: no nested-loop or
cartesian joins and no Python evaluation (everything stays in the JVM)."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
WRITES_FIXTURES = ("etl_", "scan_json_lines", "scan_with_filename", "scan_file_listing", "tsv_round_trip",
                   "csv_round_trip", "write_read_table", "insert_rows", "check_row_counts",
                   "check_rows_per_file", "catalog_tables")
KEYS = sorted(k for k in entry.queries() if not k.startswith(WRITES_FIXTURES))
BAD = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython",
       "FlatMapGroupsInPandas", "MapInPandas")


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_registered_plans_are_jvm_equi_joins(spark):
    offenders = {}
    for key in KEYS:
        plan = entry.queries()[key](spark, SF)._jdf.queryExecution().executedPlan().toString()
        hits = [b for b in BAD if b in plan]
        if hits:
            offenders[key] = hits
    assert offenders == {}
    assert len(KEYS) >= 45


def test_percent_of_total_has_no_window_and_no_single_task(spark):
    from playstats.plans import reports

    plays = spark.range(1000).select(F.col("id").alias("songplay_id"), (F.col("id") % 7).cast("string").alias("location"))
    out = reports.plays_by_location(plays)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Subquery" in plan
    outer = plan.split("Subquery")[0]
    assert "SinglePartition" not in outer
    assert abs(sum(r.songplays_percent for r in out.collect()) - 100) < 1e-9
    assert reports.plays_by_location(plays.limit(0)).collect() == []


def test_stored_counts_read_no_column(spark, tmp_path):
    from playstats.sources.tables import stored_counts

    paths = {}
    for n in (0, 5, 1000):
        paths[f"t{n}"] = str(tmp_path / f"t{n}")
        spark.range(n).withColumn("v", F.lit("x")).repartition(3).write.parquet(paths[f"t{n}"])
    spark.range(10).withColumn("p", F.col("id") % 3).write.partitionBy("p").parquet(str(tmp_path / "parts"))
    out = stored_counts(spark, paths | {"parts": str(tmp_path / "parts")})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert {r.table_name: r.n_rows for r in out.collect()} == {"t0": 0, "t5": 5, "t1000": 1000, "parts": 10}
    assert plan.count("PushedAggregation: [COUNT(*)]") == 4
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
