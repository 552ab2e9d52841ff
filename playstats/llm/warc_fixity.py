"""WARC files and their Merkle fixity audit.

*Archive*: pages become WARC/1.0 resource records, written by Spark's text
writer as gzip files of about ``FILE_BYTES`` of payload, one folder ``file_no=k`` per
file, in id order; rows of one id may lie in several files. Two CRLF end a record as
the format asks; they are read back by Spark with the record start as line separator.
Records have the four headers that the standard requires: type, id (of a null id:
``<urn:page:none>``), length and date, which is a parameter, as pages have none. A
payload that could be mistaken for a record start is stored in base64 under an
extension header, which other readers hand on undecoded.

*Tree*: a leaf is the SHA-256 of a record; a range node hashes the leaves of a run of
ordered offsets in a file; a file node hashes its ranges; above, ``FANOUT`` nodes each
form one, up to the root. Every level is a grouping of the one below, stored as a
table; no group is larger than ``LONGEST`` records, a file's ranges or ``FANOUT`` nodes.

*Ranges* are cut by content, not by offset: a range begins at each record whose id
hashes to 0 modulo ``RANGE_RECORDS``, and is known by that id, so records lost, added or
changed in length leave the other ranges of the file as they are. A lost first record
opens two ranges, its own and the one before, which takes over its records. A run of
more than ``LONGEST`` records without such an id is cut by number.

*Audit*: equal roots end it. Otherwise it descends from the root, level by
level, joining only children of nodes that differ, down to the differing
ranges; the records of those are compared by id and give each damaged,
missing or extra record with its place.

Edge cases: null url: no target header; null payload: an empty one with the
header ``X-Payload: null``; null ids are read back as null. Equal records or ids are told apart by their number in the file. Two
empty archives have equal roots; against an empty one every record is missing
or extra. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from playstats.llm.common import stored

#: Payload bytes of a file, about: what one task writes, reads and numbers.
FILE_BYTES = 32 << 20
#: Records of a range, on average, and at most.
RANGE_RECORDS = 64
LONGEST = 1024
#: The date of records whose capture time is unknown.
NO_DATE = "1970-01-01T00:00:00Z"
FANOUT = 16
CRLF = "\r\n"
START = "WARC/1.0" + CRLF
GAP = CRLF + CRLF


def record(page_id: Column, url: Column, html: Column, date: str = NO_DATE) -> Column:
    """A record as text, without the version line before and the gap after it."""
    payload = F.coalesce(html, F.lit(""))
    risky = payload.contains("WARC/1.0") | payload.endswith("\r") | payload.endswith(CRLF)
    body = F.when(risky, F.base64(F.encode(payload, "UTF-8"))).otherwise(payload)
    return F.concat(
        F.lit("WARC-Type: resource" + CRLF + "WARC-Record-ID: <urn:page:"),
        F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">" + CRLF + f"WARC-Date: {date}" + CRLF),
        F.when(url.isNull(), "").otherwise(F.concat(
            F.lit("WARC-Target-URI: "), F.regexp_replace(url, "[\r\n]", " "), F.lit(CRLF))),
        F.lit("Content-Type: text/html" + CRLF),
        F.when(html.isNull(), "X-Payload: null" + CRLF).otherwise(""),
        F.when(risky, "Content-Transfer-Encoding: base64" + CRLF).otherwise(""),
        F.lit("Content-Length: "), F.octet_length(body).cast("string"), F.lit(GAP), body)


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
               html_col: str = "html", files: int | None = None, date: str = NO_DATE) -> None:
    """Write ``pages`` in id order as WARC files below ``path``: ``files`` of them, or as
    many as their payload needs."""
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("url"),
                        F.col(f"`{html_col}`").alias("html"))
    if files is None:
        payload = rows.agg(F.sum(F.coalesce(F.octet_length("html"), F.lit(0)).cast("bigint") + 256)).first()[0]
        files = 1 + (payload or 0) // FILE_BYTES
    # the digest and the row's number split ids and rows that repeat over several files
    order = [F.col("id").asc_nulls_first(), F.col("url").asc_nulls_first(), F.col("digest"), F.col("nth")]
    ordered = (rows.withColumns({"digest": F.xxhash64("html"), "nth": F.monotonically_increasing_id()})
               .repartitionByRange(files, *order).withColumn("file_no", F.spark_partition_id())
               .sortWithinPartitions("file_no", *order))
    write_records(ordered.select("file_no", record(F.col("id"), F.col("url"), F.col("html"), date).alias("record")), path)


def write_records(ordered: DataFrame, path: str) -> None:
    """Write rows (file_no, record), sorted by file, one file per number."""
    (ordered.select("file_no", F.concat(F.lit(START), "record").alias("value"))
     .write.partitionBy("file_no").option("lineSep", GAP).option("compression", "gzip").text(path))


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(file_no, block, seq, record): the records as written, in order of (block, seq)
    within a file."""
    raw = (spark.read.schema("value string, file_no int").option("lineSep", GAP + START).text(path)
           .select("file_no", F.col("_metadata.file_block_start").alias("block"),
                   F.monotonically_increasing_id().alias("seq"), "value"))
    value = F.col("value")
    bare = F.when(value.startswith(START), F.substring(value, F.lit(len(START) + 1), F.char_length(value))).otherwise(value)
    # the last record of a file still has its gap
    ended = raw.withColumn("record", bare).withColumn("over", _surplus(F.col("record")))
    return ended.select("file_no", "block", "seq", F.when(
        (F.col("over") == len(GAP)) & F.col("record").endswith(GAP),
        F.substring("record", F.lit(1), F.char_length("record") - len(GAP))).otherwise(F.col("record")).alias("record"))


def _head(rec: Column) -> Column:
    return F.substring_index(rec, GAP, 1)


def _surplus(rec: Column) -> Column:
    """Bytes of the payload beyond its stated length."""
    stated = F.try_to_number(F.regexp_extract(_head(rec), r"Content-Length: (\d+)", 1), F.lit("9" * 18)).cast("bigint")
    return F.octet_length(rec) - F.octet_length(_head(rec)) - len(GAP) - stated


def pages_of(records: DataFrame) -> DataFrame:
    """(page_id, url, html) of the records."""
    rec, head = F.col("record"), _head(F.col("record"))
    body = F.substring(rec, F.char_length(head) + len(GAP) + 1, F.char_length(rec))
    plain = F.when(head.contains("Content-Transfer-Encoding: base64"),
                   F.decode(F.unbase64(body), "UTF-8")).otherwise(body)
    uri = F.regexp_extract(head, r"WARC-Target-URI: ([^\r]*)", 1)
    return records.select(
        record_id(rec).alias("page_id"), F.when(head.contains("WARC-Target-URI: "), uri).alias("url"),
        F.when(~head.contains("X-Payload: null"), plain).alias("html"))


def record_id(rec: Column) -> Column:
    return F.try_to_number(F.regexp_extract(_head(rec), r"<urn:page:(-?\d*)>", 1), F.lit("S" + "9" * 19)).cast("bigint")


def leaves(records: DataFrame, range_records: int = RANGE_RECORDS, longest: int = LONGEST) -> DataFrame:
    """(file_no, range_no, offset, page_id, n_bytes, sha256) of every record; ``range_no``
    is a hash of what the range is known by."""
    rec = F.col("record")
    narrow = records.select("file_no", "block", "seq", record_id(rec).alias("page_id"),
                            F.octet_length(rec).cast("bigint").alias("n_bytes"), F.sha2(rec, 256).alias("sha256"))
    size = F.col("n_bytes") + len(START) + len(GAP)
    in_file = Window.partitionBy("file_no").orderBy("block", "seq")
    first = F.pmod(F.xxhash64("page_id"), F.lit(range_records)) == 0
    placed = (narrow.withColumn("offset", F.sum(size).over(in_file) - size)
              .withColumn("run", F.count(F.when(first, 1)).over(in_file)))
    # a run's first record names it; the part cuts long runs, the time tells runs of one id apart
    in_run = Window.partitionBy("file_no", "run").orderBy("offset")
    named = (placed.withColumn("head", F.when(F.col("run") > 0, F.first("page_id").over(in_run)))
             .withColumn("part", F.floor((F.row_number().over(in_run) - 1) / longest)))
    time = F.dense_rank().over(Window.partitionBy("file_no", "head").orderBy("run"))
    return named.withColumn("time", time).select(
        "file_no", F.xxhash64(F.col("run") > 0, "head", "time", "part").alias("range_no"), "offset", "page_id",
        "n_bytes", "sha256")


def _node(order: str) -> Column:
    """Hash of the group's hashes in the order of a column."""
    pairs = F.array_sort(F.collect_list(F.struct(order, "sha256")))
    return F.sha2(F.array_join(F.transform(pairs, lambda x: x["sha256"]), ","), 256).alias("sha256")


class Tree:
    """The stored levels of one replica: leaves, ranges, and from files up to the root."""

    def __init__(self, records: DataFrame, height: int, range_records: int = RANGE_RECORDS, fanout: int = FANOUT):
        self.leaves = stored(leaves(records, range_records), "fixity-leaves")
        self.ranges = stored(self.leaves.groupBy("file_no", "range_no").agg(
            _node("offset"), F.min("offset").alias("start")), "fixity-ranges")
        level = self.ranges.groupBy(F.col("file_no").cast("bigint").alias("no")).agg(_node("start"))
        self.levels = [stored(level, "fixity-files")]
        for _ in range(height):
            up = self.levels[-1].groupBy(F.floor(F.col("no") / fanout).cast("bigint").alias("up")).agg(_node("no"))
            self.levels.append(stored(up.withColumnRenamed("up", "no"), "fixity-level"))

    def root(self) -> str | None:
        top = self.levels[-1].collect()  # one row, or none for an empty archive
        return top[0]["sha256"] if top else None


def height_of(files: int, fanout: int = FANOUT) -> int:
    """Levels above the files until one node is left."""
    height, nodes = 0, max(1, files)
    while nodes > 1:
        nodes, height = -(-nodes // fanout), height + 1
    return height


def build_trees(a: DataFrame, b: DataFrame, range_records: int = RANGE_RECORDS,
                fanout: int = FANOUT) -> tuple[Tree, Tree]:
    """Trees of equal height for two replicas' records."""
    last = a.select("file_no").unionAll(b.select("file_no")).agg(F.max("file_no")).first()[0]
    height = height_of((last or 0) + 1, fanout)
    return Tree(a, height, range_records, fanout), Tree(b, height, range_records, fanout)


def _differing(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    x = a.withColumnRenamed("sha256", "ha")
    y = b.withColumnRenamed("sha256", "hb")
    return x.join(y, keys, "full").filter(~F.col("ha").eqNullSafe(F.col("hb"))).select(*keys)


def bad_ranges(a: Tree, b: Tree, fanout: int = FANOUT) -> DataFrame | None:
    """(file_no, range_no) of ranges that differ; None when the roots are equal."""
    if a.root() == b.root():
        return None
    parents = None
    for x, y in zip(reversed(a.levels), reversed(b.levels)):
        if parents is not None:
            x, y = (t.join(parents, F.floor(t["no"] / fanout) == parents["up"], "left_semi")
                    for t in (x, y))
        parents = stored(_differing(x, y, ["no"]), "fixity-bad").select(F.col("no").alias("up"))
    files = parents.select(F.col("up").cast("int").alias("file_no"))
    x, y = (t.ranges.join(files, "file_no", "left_semi") for t in (a, b))
    return stored(_differing(x, y, ["file_no", "range_no"]), "fixity-bad")


def audit(a: Tree, b: Tree, fanout: int = FANOUT) -> DataFrame:
    """Every record of replica ``a`` and every extra one of ``b``: (file_no, offset,
    page_id, n_bytes, sha256, found_sha256, status); status is ok, altered,
    missing or extra."""
    bad = bad_ranges(a, b, fanout)
    mine = a.leaves.select("file_no", "range_no", "offset", "page_id", "n_bytes", "sha256")
    if bad is None:
        return mine.select("file_no", "offset", "page_id", "n_bytes", "sha256",
                           F.col("sha256").alias("found_sha256"), F.lit("ok").alias("status"))
    copy = Window.partitionBy("file_no", "page_id").orderBy("offset")
    x, y = (t.leaves.join(bad, ["file_no", "range_no"], "left_semi").withColumn("copy", F.row_number().over(copy))
            for t in (a, b))
    y = y.select(F.col("file_no").alias("f"), F.col("page_id").alias("p"), F.col("copy").alias("c"),
                 F.col("offset").alias("o"), F.col("n_bytes").alias("n"), F.col("sha256").alias("found_sha256"))
    same = (x["file_no"] == y["f"]) & x["page_id"].eqNullSafe(y["p"]) & (x["copy"] == y["c"])
    status = (F.when(F.col("found_sha256").isNull(), "missing").when(F.col("sha256").isNull(), "extra")
              .when(F.col("sha256") != F.col("found_sha256"), "altered").otherwise("ok"))
    compared = x.join(y, same, "full").select(
        F.coalesce("file_no", "f").alias("file_no"), F.coalesce("offset", "o").alias("offset"),
        F.when(F.col("sha256").isNull(), F.col("p")).otherwise(F.col("page_id")).alias("page_id"),
        F.coalesce("n_bytes", "n").alias("n_bytes"), "sha256", "found_sha256", status.alias("status"))
    good = mine.join(bad, ["file_no", "range_no"], "left_anti").select(
        "file_no", "offset", "page_id", "n_bytes", "sha256", F.col("sha256").alias("found_sha256"),
        F.lit("ok").alias("status"))
    return good.unionByName(compared)
