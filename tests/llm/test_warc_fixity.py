import re

from playstats.llm import warc_fixity as w
from playstats.llm.common import shared_path
from playstats.llm.queries import damaged
from pyspark.sql import functions as F

ODD = [(1, "http://a/1", "<html>\r\n\r\nplain</html>"), (2, "http://a/2\r\nX: y", "tail\r\n"), (3, None, None),
       (4, "http://a/4", ""), (5, "u", "x\r\n\r\nWARC/1.0\r\nWARC-Type: resource\r\n\r\nfake"), (6, "u", "é日本\r"),
       (7, "u", "\r\n\r\n"), (8, "u", "WARC/1.0"), (9, "u", "Content-Length: 3\r\n\r\n<urn:page:99>"), (None, "u", "no id"),
       (-12, "u", "minus"), (10, "u", "twice"), (10, "u", "twice"), (11, "u", "z" * 200_000)]
SCHEMA = "page_id bigint, url string, html string"


def pages(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def archive(spark, rows, files=3):
    path = shared_path(spark, "test-warc")
    w.write_warc(pages(spark, rows).selectExpr("*", "1 as file_no", "2 as id", "'x' as record"), path, files=files)
    return path


def test_round_trip(spark):
    got = w.pages_of(w.read_warc(spark, archive(spark, ODD))).collect()
    want = [(i, u and u.replace("\r\n", "  "), h) for i, u, h in ODD]
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))


def test_files_are_warc(spark):
    path = archive(spark, ODD, files=1)
    raw = spark.read.schema("value string, file_no int").text(path, wholetext=True).first()["value"]
    data, found = raw.encode(), 0
    while data:  # as a plain reader would: header, stated length, two line ends
        head, _, rest = data.partition(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.0\r\n")
        for name in (b"WARC-Type: resource\r\n", b"WARC-Date: 1970-01-01T00:00:00Z\r\n", b"Content-Length: "):
            assert head.count(b"\r\n" + name.rstrip()) == 1
        assert re.search(rb"\r\nWARC-Record-ID: <urn:page:(-?\d+|none)>\r\n", head)
        size = int(head.partition(b"Content-Length: ")[2].split(b"\r\n")[0])
        assert rest[size:size + 4] == b"\r\n\r\n"
        data, found = rest[size + 4:], found + 1
    assert found == len(ODD)


def _second(spark, first, change, drop=(), twice=()):
    rec = F.col("record")
    kept = w.read_warc(spark, first)
    pid = w.record_id(rec)
    rows = (kept.withColumn("record", F.when(pid.isin(*change) if change else F.lit(False), F.concat(rec, F.lit("!"))).otherwise(rec))
            .filter(~F.coalesce(pid.isin(*drop) if drop else F.lit(False), F.lit(False)))
            .withColumn("copy", F.explode(F.when(pid.isin(*twice) if twice else F.lit(False), F.array(F.lit(1), F.lit(2)))
                                          .otherwise(F.array(F.lit(1))))))
    path = shared_path(spark, "test-warc")
    w.write_records(rows.repartition(2, "file_no").sortWithinPartitions("file_no", "block", "seq", "copy")
                    .select("file_no", "record"), path)
    return path


def test_audit_locates_every_damage(spark):
    rows = [(i, f"http://h/{i}", f"page {i} " * (i % 40)) for i in range(400)]
    first = archive(spark, rows, files=20)
    second = _second(spark, first, change=[17, 300], drop=[5, 399], twice=[100])
    a, b = w.build_trees(w.read_warc(spark, first), w.read_warc(spark, second), range_records=4, fanout=3)
    assert len(a.levels) == 1 + w.height_of(20, 3) and a.root() != b.root()
    bad = w.bad_ranges(a, b, fanout=3)
    assert 0 < bad.count() < a.ranges.count() / 2  # only damaged files are opened
    got = w.audit(a, b, fanout=3).collect()
    assert len(got) == 401
    assert sorted((r.page_id, r.status) for r in got if r.status != "ok") == [
        (5, "missing"), (17, "altered"), (100, "extra"), (300, "altered"), (399, "missing")]


def test_equal_and_empty_replicas(spark):
    first = archive(spark, ODD)
    same = _second(spark, first, change=[])
    a, b = w.build_trees(w.read_warc(spark, first), w.read_warc(spark, same))
    assert a.root() == b.root() and w.bad_ranges(a, b) is None
    assert {r.status for r in w.audit(a, b).collect()} == {"ok"}
    none = w.read_warc(spark, first).limit(0)
    a, b = w.build_trees(w.read_warc(spark, first), none)
    assert [r.status for r in w.audit(a, b).collect()] == ["missing"] * len(ODD)
    a, b = w.build_trees(none, none)
    assert a.root() is None and w.audit(a, b).count() == 0


def _open(spark, rows, drop, **how):
    """Ranges of one file that differ, and all, when records are lost."""
    first = archive(spark, rows, files=1)
    second = _second(spark, first, change=[], drop=drop)
    a, b = w.build_trees(w.read_warc(spark, first), w.read_warc(spark, second), **how)
    lost = sorted(r.page_id for r in w.audit(a, b).filter("status = 'missing'").collect())
    assert lost == sorted(i for i, _, _ in rows if i in drop)
    assert w.audit(a, b).filter("status not in ('ok', 'missing')").count() == 0
    return w.bad_ranges(a, b).count(), a.ranges.count()


def test_a_lost_record_opens_two_ranges_at_most(spark):
    rows = [(i, f"http://h/{i}", f"page {i} " * (i % 9)) for i in range(500)]
    heads = [r.id for r in spark.range(500).filter("pmod(xxhash64(id), 8) = 0").collect()]
    bad, every = _open(spark, rows, [next(i for i in range(1, 500) if i not in heads)], range_records=8)
    assert bad == 1 and every > 30
    assert _open(spark, rows, heads[3:4], range_records=8)[0] == 2


def test_hot_and_null_ids_are_cut_by_number_and_split_over_files(spark):
    rows = [(5, "u", "same")] * 3000 + [(None, "u", f"x{i}") for i in range(3000)] + [(i, "u", "y") for i in range(100)]
    first = archive(spark, rows, files=6)
    records = w.read_warc(spark, first)
    assert max(r["count"] for r in records.groupBy("file_no").count().collect()) < 2 * len(rows) / 6
    a, b = w.build_trees(records, records)
    assert a.leaves.groupBy("file_no", "range_no").count().agg(F.max("count")).first()[0] <= w.LONGEST
    assert w.bad_ranges(a, b) is None and a.leaves.count() == len(rows)


def test_files_follow_the_payload(spark, monkeypatch):
    monkeypatch.setattr(w, "FILE_BYTES", 4000)
    rows = [(i, "u", "z" * 500) for i in range(64)]
    path = shared_path(spark, "test-warc")
    w.write_warc(pages(spark, rows), path)
    assert 8 <= w.read_warc(spark, path).select("file_no").distinct().count() <= 14


def test_the_damaged_replica_shuffles_no_record(spark):
    rows = [(i, "u", f"page {i} " * 50) for i in range(300)]
    kept = w.read_warc(spark, archive(spark, rows, files=5))
    second = damaged(kept)
    assert "Exchange" not in second._jdf.queryExecution().executedPlan().toString()
    path = shared_path(spark, "test-warc")
    w.write_records(second, path)
    found = w.read_warc(spark, path)
    assert found.select(F.input_file_name()).distinct().count() == found.select("file_no").distinct().count() == 5
    # id order holds from file to file and within each
    ids = [r.id for r in found.select("file_no", "block", "seq", w.record_id(F.col("record")).alias("id"))
           .orderBy("file_no", "block", "seq").collect()]
    lost = {r.id for r in spark.range(300).filter("substring(sha2(string(id), 256), 1, 2) in ('04', '05')").collect()}
    assert ids == sorted(ids) and set(ids) == set(range(300)) - lost
