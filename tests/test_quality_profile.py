import datetime as dt

import pytest

from playstats.operators import profile, quality


def test_primary_key_and_not_null(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "c")], "k int, v string")
    bad = {r.k: r.n_rows for r in quality.primary_key_violations(df, ["k"]).collect()}
    assert bad == {1: 2, None: 1}
    assert {r.column_name: r.null_count for r in quality.null_counts(df, ["k", "v"]).collect()} == \
        {"k": 1, "v": 1}
    with pytest.raises(quality.QualityError):
        quality.assert_primary_key(df, ["k"], "t")
    with pytest.raises(quality.QualityError):
        quality.assert_not_null(df, ["v"], "t")
    quality.assert_primary_key(df.filter("k = 2"), ["k"], "t")


def test_foreign_key(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,), (5,)], "fk int")
    parent = spark.createDataFrame([(1,), (5,)], "pk int")
    assert [tuple(r) for r in quality.foreign_key_violations(child, ["fk"], parent, ["pk"]).collect()] == [(2, 2)]


def test_row_count_check(spark):
    a = spark.range(10)
    r = quality.row_count_check(a, a.filter("id < 9"), "t").collect()[0]
    assert (r.expected_rows, r.loaded_rows, r.ok) == (10, 9, False)


def test_numeric_profile_interpolates(spark):
    df = spark.createDataFrame([(1.0, 10), (2.0, None), (4.0, 30)], "x double, y int")
    p = {r.column_name: r for r in profile.profile_numeric(df, ["x", "y"]).collect()}
    x = p["x"]
    assert (x["count"], x.min, x.p25, x.p50, x.p75, x.max) == (3, 1.0, 1.5, 2.0, 3.0, 4.0)
    assert abs(x.mean - 7 / 3) < 1e-12 and abs(x.std - 1.5275252316519468) < 1e-12
    assert (p["y"]["count"], p["y"].p50) == (2, 20.0)


def test_text_and_timestamp_profile(spark):
    df = spark.createDataFrame([("b", dt.datetime(2020, 1, 2)), ("a", dt.datetime(2020, 1, 1)),
                                ("b", dt.datetime(2020, 1, 1)), ("a", None), (None, None)],
                               "s string, t timestamp_ntz")
    r = profile.profile_text(df, ["s"]).collect()[0]
    assert (r["count"], r.unique, r.top, r.freq) == (4, 2, "a", 2)   # tie -> smallest value
    t = profile.profile_timestamp(df, ["t"]).collect()[0]
    assert (t["count"], t.unique, t.top, t.freq, t.first, t.last) == \
        (3, 2, dt.datetime(2020, 1, 1), 2, dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 2))
    k = profile.key_cardinality(df, "s").collect()[0]
    assert tuple(k) == (5, 4, 2, 3)
    d = {r.column_name: (r.data_type, r.non_null) for r in profile.profile_dtypes(df).collect()}
    assert d == {"s": ("string", 4), "t": ("timestamp_ntz", 3)}
