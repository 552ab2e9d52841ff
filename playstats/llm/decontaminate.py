"""Benchmark decontamination with DataFrame functions only.

Words are runs of digits, a-z (A-Z lower-cased) and all non-ASCII characters. A
window is ``n`` consecutive words of a benchmark item; an item of fewer words,
but not none, is one window as it is.

The distinct windows form a small table keyed by their 64-bit hash, which is
broadcast as a hash set when its measured size allows. Document windows are
generated and hashed inside one code-generated stage and probe that table; a hit
is verified on the words themselves. No document window is shuffled; only hits
are grouped, by document. Above ``broadcast_bytes`` of windows the join is left
to the planner, which shuffles both sides by hash.

Edge cases: null or empty text has no words, so neither windows nor hits;
repeated window occurrences and repeated benchmark items count once per item
id; items without id are ignored in ``item_ids``, but their windows hit;
repeated rows and ids are judged row by row; empty tables give no hits or no
rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playstats.llm.common import stored

NGRAM = 10
BROADCAST_BYTES = 64 << 20

#: Characters between words: ASCII but for digits and letters (the second form: before lower-casing).
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BREAKS_CASED = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, all else unchanged."""
    return (F.when(F.octet_length(text) == F.char_length(text), F.lower(text))
            .otherwise(F.translate(text, UPPER, LOWER)))


def item_words(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), BREAKS), "")


def _window_hash(words: Column, at: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(words, at + k) for k in range(size)])


def _window_text(words: Column, at: Column, size: int | Column) -> Column:
    return F.array_join(F.slice(words, at + 1, size), " ")


def benchmark_windows(benchmark: DataFrame, n: int = NGRAM, item_col: str = "item_id",
                      text_col: str = "text") -> DataFrame:
    """(size, window, item_ids): the distinct windows of all items."""
    items = benchmark.select(F.col(f"`{item_col}`").cast("string").alias("item"),
                             item_words(F.col(f"`{text_col}`")).alias("words"))
    size = F.least(F.size("words"), F.lit(n))
    last = F.greatest(F.size("words") - n, F.lit(0))
    places = F.when(F.size("words") > 0, F.sequence(F.lit(0), last))
    return (items.select("item", "words", size.alias("size"), F.explode(places).alias("at"))
            .select("item", "size", _window_text(F.col("words"), F.col("at"), F.col("size")).alias("window"))
            .groupBy("size", "window").agg(F.collect_set("item").alias("item_ids")))


def window_hits(documents: DataFrame, windows: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(doc_id, text_hash, at, size, item_ids) for each place of a document where a
    window occurs; ``at``: the first word's number."""
    facts = windows.agg(F.collect_set("size").alias("sizes"),
                        F.sum(F.octet_length("window") + 64).alias("bytes")).first()
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    words = documents.select(F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(text).alias("text_hash"),
                             item_words(text).alias("words"))
    hits = None
    for size in sorted(facts["sizes"]) or [NGRAM]:  # one size, and the shorter items' sizes: n at most
        of_size = windows.filter(F.col("size") == size).select(
            F.xxhash64(*[F.get(F.split("window", " "), F.lit(k)) for k in range(size)]).alias("h"),
            "window", "item_ids")
        places = F.when(F.size("words") >= size, F.sequence(F.lit(0), F.size("words") - size))
        if (facts["bytes"] or 0) <= broadcast_bytes:
            # outer: else the planner repeats the split in a filter of its own
            near = (words.select("doc_id", "text_hash", "words", F.explode_outer(places).alias("at"))
                    .withColumn("h", _window_hash(F.col("words"), F.col("at"), size))
                    .join(F.broadcast(of_size), "h"))
        else:
            near = _shuffled_probe(words, of_size, places, size)
        found = (near.filter(_window_text(F.col("words"), F.col("at"), size) == F.col("window"))
                 .select("doc_id", "text_hash", "at", F.lit(size).alias("size"), "item_ids"))
        hits = found if hits is None else hits.unionAll(found)
    return hits


def _shuffled_probe(words: DataFrame, of_size: DataFrame, places: Column, size: int) -> DataFrame:
    """Places whose hash is a window's, with the words to verify them by. Only hashes and
    places are shuffled to the windows; a document's words move once, to its candidates."""
    hashes = F.transform(places, lambda at: _window_hash(F.col("words"), at, size))
    probe = words.select("doc_id", "text_hash", F.posexplode_outer(hashes).alias("at", "h"))
    few = (probe.join(of_size, "h").groupBy("doc_id", "text_hash")
           .agg(F.collect_set(F.struct("at", "window", "item_ids")).alias("found"))
           .select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "found"))
    same = words["doc_id"].eqNullSafe(few["_id"]) & (words["text_hash"] == few["_hash"])
    return words.join(few, same).select("doc_id", "text_hash", "words", F.inline("found"))


def contamination(documents: DataFrame, benchmark: DataFrame, n: int = NGRAM, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text") -> DataFrame:
    """For every row: (doc_id, n_words, n_hit, item_ids sorted, spans, contaminated,
    text_hash). ``spans``: merged word ranges [start, stop) that are hit."""
    windows = stored(benchmark_windows(benchmark, n, item_col, item_text_col), "benchmark-windows")
    hits = window_hits(documents, windows, id_col, text_col)
    # one document's hits are bounded by its words
    found = hits.groupBy("doc_id", "text_hash").agg(
        F.array_sort(F.collect_set(F.struct("at", "size"))).alias("_hits"),
        F.collect_set("item_ids").alias("_items"))
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    base = documents.select(F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(text).alias("text_hash"),
                            F.size(item_words(text)).cast("bigint").alias("n_words"))
    same = base["doc_id"].eqNullSafe(found["doc_id"]) & (base["text_hash"] == found["text_hash"])
    joined = base.join(found, same, "left").select(
        base["doc_id"], "n_words", base["text_hash"],
        F.coalesce(F.col("_hits"), F.array().cast("array<struct<at:int,size:int>>")).alias("_hits"),
        F.coalesce(F.array_sort(F.array_distinct(F.flatten("_items"))),
                   F.array().cast("array<string>")).alias("item_ids"))
    none = F.array().cast("array<struct<start:int,stop:int>>")

    def grow(spans: Column, hit: Column) -> Column:
        last = F.element_at(spans, -1)
        stop = hit["at"] + hit["size"]
        return (F.when((F.size(spans) > 0) & (F.try_element_at(spans, F.lit(-1))["stop"] >= hit["at"]),
                       F.concat(F.slice(spans, 1, F.size(spans) - 1),
                                F.array(F.struct(last["start"].alias("start"),
                                                 F.greatest(last["stop"], stop).alias("stop")))))
                .otherwise(F.concat(spans, F.array(F.struct(hit["at"].alias("start"), stop.alias("stop"))))))

    spans = F.aggregate("_hits", none, grow)
    covered = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["stop"] - s["start"])
    return (joined.withColumn("spans", spans).withColumn("n_hit", covered)
            .select("doc_id", "n_words", "n_hit", "item_ids", "spans", (F.col("n_hit") > 0).alias("contaminated"), "text_hash"))


def contamination_digest(report: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of a report."""
    return report.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
                         F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


def remove_spans(documents: DataFrame, report: DataFrame, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """The documents without the words (and what follows each up to the next word)
    in the report's spans. A span is found by id and text, so ids may be null or
    repeated. Other rows are unchanged."""
    text = F.col(f"`{text_col}`")
    # equal rows have equal spans
    dirty = report.filter("contaminated").groupBy("doc_id", "text_hash").agg(F.first("spans").alias("_spans")).select(
        F.col("doc_id").alias("_of"), F.col("text_hash").alias("_hash"), "_spans")
    lead = F.regexp_extract(text, f"^[{BREAKS_CASED}]*", 0)
    pieces = F.regexp_extract_all(text, F.lit(f"[^{BREAKS_CASED}]+[{BREAKS_CASED}]*"), F.lit(0))
    clean = F.filter(pieces, lambda p, k: ~F.exists("_spans", lambda s: (k >= s["start"]) & (k < s["stop"])))
    same = F.col(f"`{id_col}`").eqNullSafe(F.col("_of")) & (F.xxhash64(F.coalesce(text, F.lit(""))) == F.col("_hash"))
    cut = F.when(F.col("_spans").isNotNull(), F.concat(lead, F.array_join(clean, ""))).otherwise(text)
    return documents.join(dirty, same, "left").select(
        *[cut.alias(c) if c == text_col else F.col(f"`{c}`") for c in documents.columns])
