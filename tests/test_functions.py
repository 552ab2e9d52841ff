import datetime as dt

import pytest
from pyspark.sql import functions as F

from playstats.functions.cleaning import clean_frame, split_numeric, to_number
from playstats.functions.text import full_name
from playstats.functions.timeparts import (epoch_ms_to_start_time, floor_to_second, ntz_to_epoch_ms,
                                           time_part_columns)

MS = {
    "ms_796": 1541121934796,             # 2018-11-02 01:25:34.796
    "neg": -1500,                        # 1969-12-31 23:59:58.5
    "dec31": 1546214400000,              # 2018-12-31 00:00 (Monday, ISO week 1)
    "jan1": 1451606400000,               # 2016-01-01 00:00 (Friday, ISO week 53)
    "sunday": 1546128000000,             # 2018-12-30 00:00 (Sunday)
}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_time_parts_zone_free(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(k, v) for k, v in MS.items()], "k string, ts long")
        out = df.select("k", epoch_ms_to_start_time("ts").alias("st"))
        out = out.withColumns(time_part_columns("st"))
        r = {x.k: x for x in out.collect()}
        assert r["ms_796"].st == dt.datetime(2018, 11, 2, 1, 25, 34)
        assert r["neg"].st == dt.datetime(1969, 12, 31, 23, 59, 58)
        assert (r["dec31"].week, r["dec31"].weekday) == (1, 0)
        assert (r["jan1"].week, r["jan1"].year) == (53, 2016)
        assert r["sunday"].weekday == 6
        assert r["ms_796"].hour == 1 and r["ms_796"].day == 2 and r["ms_796"].month == 11
        gap = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-10 02:30:45.9' AS t").select(
            floor_to_second("t").alias("f"), F.hour("t").alias("h"), ntz_to_epoch_ms("t").alias("ms"))
        g = gap.collect()[0]
        assert g.f == dt.datetime(2024, 3, 10, 2, 30, 45) and g.h == 2   # no DST shift
        assert g.ms == 1710037845900
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_clean_frame_rules(spark):
    df = spark.createDataFrame([("", 1.0), ("\t", float("nan")), ("a\tb", None), (None, 2.0),
                                ("NULL", 3.0)], "s string, x double")
    got = [tuple(r) for r in clean_frame(df).collect()]
    assert got[0] == (None, 1.0)
    assert got[1][0] == "" and got[1][1] is None          # tab-only cell -> '' (tab removed after '' check)
    assert got[2] == ("ab", None)
    assert got[3] == (None, 2.0)
    assert got[4] == ("NULL", 3.0)                         # the token is only a sink concern
    strict = [tuple(r) for r in clean_frame(df, null_token="NULL", whole_cell=True).collect()]
    assert strict[2][0] == "a\tb" and strict[4][0] is None


def test_to_number_strict_and_lenient(spark):
    df = spark.createDataFrame([("88",), ("12",), (None,), ("abc",)], "u string")
    with pytest.raises(Exception, match="not a number"):
        to_number(df, "u").collect()
    ok = to_number(df.filter(F.col("u") != "abc"), "u").collect()
    assert sorted(r.u for r in ok) == [12, 88]
    good, bad = split_numeric(df, "u")
    assert sorted((r.u for r in good.collect()), key=lambda v: (v is None, v)) == [12, 88, None]
    assert [r.u for r in bad.collect()] == ["abc"]


def test_full_name_null_propagates(spark):
    df = spark.createDataFrame([("Ann", "Lee"), ("Bob", None)], "f string, l string")
    assert [r.n for r in df.select(full_name("f", "l").alias("n")).collect()] == ["Ann Lee", None]


def test_scale_conf_sizes_partitions():
    from playstats.session import scale_conf

    big = scale_conf(100 * 2**40, 8000)
    assert big["spark.sql.shuffle.partitions"] == str(100 * 2**10)     # one per GiB, no cap of its own
    assert scale_conf(100 * 2**40, 8000, max_shuffle_partitions=50_000)["spark.sql.shuffle.partitions"] == "50000"
    assert big["spark.sql.files.maxPartitionBytes"] == str(1 << 30)
    small = scale_conf(10 * 2**30, 80)
    assert small["spark.sql.shuffle.partitions"] == "240"              # three waves per core
    assert small["spark.sql.adaptive.skewJoin.enabled"] == "true"
