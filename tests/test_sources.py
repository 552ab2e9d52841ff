import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playstats.schemas import LOG_SCHEMA, SONG_SCHEMA
from playstats.sinks.writers import write_csv, write_tsv
from playstats.sources.delimited import read_csv, read_tsv
from playstats.sources.files import list_files, read_json_lines, with_source_file

from conftest import write_lines


def test_listing_skips_hidden_folders_and_other_files(spark, song_tree):
    paths = [r.file_path for r in list_files(spark, song_tree).collect()]
    assert len(paths) == 6
    assert all(p.endswith(".json") for p in paths)
    assert not any(".ipynb_checkpoints" in p for p in paths)
    with pytest.raises(ValueError):
        list_files(spark, "")


def test_song_scan_distinct_and_text_kept(spark, song_tree):
    df = read_json_lines(spark, song_tree, SONG_SCHEMA)
    rows = {r.song_id: r for r in df.collect()}
    assert sorted(rows) == ["SOA", "SOB", "SOC", "SOD", "SOE"]      # copy of SOA collapsed
    assert rows["SOB"].title == "007"                                 # no number inference
    assert str(rows["SOA"].duration) == "218.9317900000"             # exact decimal
    assert "num_songs" not in df.columns                              # declared fields only ...
    wide = read_json_lines(spark, song_tree, SONG_SCHEMA, undeclared="infer")
    assert "num_songs" in wide.columns and wide.count() == 5          # ... unless inferred


def test_type_only_duplicates_collapse_but_extra_fields_count(spark, tmp_path):
    base = {"ts": 1, "userId": "88", "page": "NextSong", "extra": "a"}
    p = write_lines(str(tmp_path / "l" / "x.json"), [base, {**base, "extra": "b"}],
                    raw_lines=['{"ts": 1, "userId": 88, "page": "NextSong", "extra": "a"}'])
    assert p
    for mode in ("keep", "infer"):
        df = read_json_lines(spark, str(tmp_path / "l"), LOG_SCHEMA, undeclared=mode)
        assert df.count() == 2                                        # 88 == "88"; extra differs
    assert read_json_lines(spark, str(tmp_path / "l"), LOG_SCHEMA, undeclared="drop").count() == 1


def test_rows_per_file_and_provenance(spark, song_tree):
    from playstats.operators.quality import rows_per_file_check

    df = read_json_lines(spark, song_tree, SONG_SCHEMA, distinct=False, source_file_col="source_file")
    r = rows_per_file_check(df).collect()[0]
    assert (r.n_rows, r.n_files, r.ok) == (6, 6, True)
    plain = with_source_file(read_json_lines(spark, song_tree, SONG_SCHEMA, distinct=False, undeclared="drop"))
    assert plain.select("source_file").distinct().count() == 6


def test_empty_folder_gives_no_rows_and_missing_path_raises(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    for mode in ("keep", "infer", "drop"):
        assert read_json_lines(spark, str(tmp_path / "empty"), LOG_SCHEMA, undeclared=mode).count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        read_json_lines(spark, str(tmp_path / "missing"), LOG_SCHEMA).count()
    with pytest.raises(ValueError):
        read_json_lines(spark, "", LOG_SCHEMA)


def test_delimited_round_trips(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("s", T.StringType())])
    values = [(1, "a\tb"), (2, 'q"uote'), (3, "c,omma"), (4, "back\\slash"), (5, ""), (6, None),
              (7, "NULL"), (8, "line")]
    df = spark.createDataFrame(values, schema)
    tsv = dict(read_tsv(spark, write_tsv(df, str(tmp_path / "t")), schema).collect())
    assert tsv == {**dict(values), 7: None}                           # only the token text changes
    csv = dict(read_csv(spark, write_csv(df, str(tmp_path / "c")), schema).collect())
    assert csv == dict(values)                                        # NULL and '' both survive
    raw = "".join(open(f).read() for f in (tmp_path / "t").glob("part-*.csv"))
    assert "\tNULL\n" in raw


def test_tsv_reader_fails_on_bad_rows(spark, tmp_path):
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.csv").write_text("1\tabc\n")
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("n", T.IntegerType())])
    with pytest.raises(Exception):
        read_tsv(spark, str(tmp_path / "bad"), schema).collect()


def test_parquet_scan_prunes_and_pushes(spark):
    df = (spark.read.parquet("/root/testdata/sf0.001/events.parquet")
          .filter(F.col("event_type") == "view").select("event_id"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,view)]" in plan
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in plan


def test_scan_table_by_path_and_by_name(spark):
    from playstats.sources.tables import scan_table

    by_path = scan_table(spark, "/root/testdata/sf0.001/nation.parquet")
    assert by_path.count() == 25
    by_path.createOrReplaceTempView("nation_scan_test")
    assert scan_table(spark, "nation_scan_test").count() == 25


def test_delimited_keeps_every_text(spark, tmp_path):
    from playstats.sinks.writers import write_csv, write_tsv
    from playstats.sources.delimited import read_csv, read_tsv

    texts = ["", " ", "\n", "\r\n", "a\nb\r", "\\", "\\n", "\\\\n", "\\\\\\n\n", "\\N", "\\\\N", "\u0001", '"', '"a","b"', "a\tb",
             ",", " pad ", "\\r", "#x", "NULL ", "é\n日本", None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    for write, read in ((write_tsv, read_tsv), (write_csv, read_csv)):
        path = write(df, str(tmp_path / write.__name__))
        raw = spark.read.text(path)
        assert raw.count() == len(texts)                        # one line per record: files stay splittable
        assert {r.i: r.t for r in read(spark, path, df.schema).collect()} == dict(enumerate(texts))


def test_rows_per_file_one_object_per_file(spark, tmp_path):
    import json

    from playstats.operators.quality import rows_per_file_check
    from playstats.schemas import SONG_SCHEMA
    from playstats.sources.files import read_json_lines

    for i in range(5):
        (tmp_path / f"s{i}.json").write_text(json.dumps({"song_id": f"S{i}"}) + "\n")
    df = read_json_lines(spark, str(tmp_path), SONG_SCHEMA, distinct=False, source_file_col="source_file")
    assert [tuple(r) for r in rows_per_file_check(df).collect()] == [(5, 5, True)]
