"""Document fingerprints: bottom-k sketches of shingle hashes, with DataFrame
functions only.

A fingerprint is the sorted array of the ``k`` smallest distinct 64-bit hashes
of a text's word shingles. Two sketches merge into the sketch of the union, so
a text or corpus can be sketched in parts. From sketches come the resemblance
and containment of two texts and the number of distinct shingles; for sets of
up to ``k`` shingles all are exact.

Edge cases: null or empty text, or no word: the empty fingerprint; two of them
resemble each other by 1.0 (equal texts), an empty and another one by 0.0.
Fewer words than a shingle: the whole sequence is one shingle. Rows that repeat
both id and text are one document and give one row; rows of one id with other
texts follow one another in the order of a hash of the text; null ids come
first. One document alone is its own next. An empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playstats.llm.common import id_text, stored

SHINGLE_WORDS = 5
K = 128
WHITE_BREAKS = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Width of the hash range, for the estimate of distinct shingles.
RANGE = 2.0 ** 64
NO_HASHES = "array<bigint>"


def words(text: Column) -> Column:
    """Lower-cased (A-Z) words between white space."""
    low = (F.when(F.octet_length(text) == F.char_length(text), F.lower(text))
           .otherwise(F.translate(text, UPPER, LOWER)))
    return F.array_remove(F.split(low, WHITE_BREAKS), "")


def shingle_hashes(w: Column, size: int = SHINGLE_WORDS) -> Column:
    """Hashes of all shingles of an array of words."""
    many = F.transform(F.sequence(F.lit(0), F.size(w) - size),
                       lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(size)]))
    one = F.array(F.xxhash64(F.array_join(w, " ")))
    return (F.when(F.size(w) >= size, many).when(F.size(w) > 0, one)
            .otherwise(F.array().cast(NO_HASHES)))


def bottom_k(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of the union of two sketched sets."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimate of |A n B| / |A u B|: the share of the union's sketch in both."""
    union = merge(a, b, k)
    both = F.size(F.array_intersect(union, F.array_intersect(a, b)))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(both / F.size(union))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimate of |A|: exact below ``k``, else from the k-th smallest hash."""
    # signed hashes start at -2^63
    kth = F.try_element_at(a, F.lit(k)).cast("double") + RANGE / 2
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / (kth / RANGE))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimate of |A n B| / |A|, from the resemblance and the sizes; 1.0 for an empty A."""
    both = resemblance(a, b, k) * distinct_shingles(merge(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), both / distinct_shingles(a, k)))


def to_text(sketch: Column) -> Column:
    """The fingerprint as a string of 16 hex digits per hash."""
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def sketches(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K,
             size: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, sketch) of every whole text."""
    return (id_text(documents, id_col, text_col).select("doc_id", words(F.col("text")).alias("w"))
            .select("doc_id", bottom_k(shingle_hashes(F.col("w"), size), k).alias("sketch")))


def merged_by(sketched: DataFrame, key: str, sketch: str = "sketch", k: int = K) -> DataFrame:
    """(key, sketch): the sketch of each key's union. The rank limit is applied in
    every task before the shuffle, so a hot key sends ``k`` hashes per task."""
    each = sketched.select(key, F.explode(sketch).alias("h")).distinct()
    least = each.withColumn("r", F.row_number().over(Window.partitionBy(key).orderBy("h"))).filter(F.col("r") <= k)
    return least.groupBy(key).agg(F.sort_array(F.collect_list("h")).alias(sketch))


def keyed(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, kid, text_hash): kid and text_hash name a distinct (id, text)
    without nulls, and kid orders as the id does, null first."""
    return (id_text(documents, id_col, text_col)
            .withColumn("kid", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63)).cast("bigint")))
            .withColumn("text_hash", F.xxhash64(F.col("doc_id").isNull(), "text")))


def next_in_order(keys: DataFrame) -> DataFrame:
    """Each row (kid, text_hash, ...) of distinct ``keys`` with the key of the next
    one in ascending order as (next_kid, next_hash); the first follows the last.

    Rows are range-partitioned and numbered by partition; the next row is found
    inside a partition, and at its end in a table of one row per partition."""
    parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["kid", "text_hash"]
    ranged = stored(keys.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()),
                    "fingerprint-order")
    ranged = ranged.withColumn("own", F.struct(*order))
    firsts = ranged.groupBy("part").agg(F.min("own").alias("first"))
    every = Window.orderBy("part")  # one row per partition
    whole = every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = firsts.select("part", F.coalesce(F.lead("first").over(every), F.first("first").over(whole)).alias("first"))
    inside = F.lead("own").over(Window.partitionBy("part").orderBy(*order))
    follows = F.coalesce("next", "first")
    return (ranged.withColumn("next", inside).join(after, "part")
            .select(*keys.columns, follows["kid"].alias("next_kid"), follows["text_hash"].alias("next_hash")))


def fingerprint_pairs(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K,
                      size: int = SHINGLE_WORDS) -> DataFrame:
    """Per document: the sketches of its text, of its edited text and of the next
    document's text: (doc_id, kid, text_hash, n_chars, edited_sha256, sketch,
    edited_sketch, next_sketch). The edited text has the last floor(n_chars / 2)
    code points replaced by the first as many of the next document.

    Whole texts are shuffled once, by their key; a document then sends only the
    head that the one before it needs, and its sketch."""
    docs = keyed(documents, id_col, text_col)
    half = (F.col("n_chars") / 2).cast("int")
    keys = docs.select("doc_id", "kid", "text_hash", F.char_length("text").cast("bigint").alias("n_chars")).distinct()
    links = next_in_order(keys).select("doc_id", "n_chars", F.col("kid").alias("to_kid"),
                                       F.col("text_hash").alias("to_hash"), F.col("next_kid").alias("kid"),
                                       F.col("next_hash").alias("text_hash"))
    # repeated rows become one before the shuffle; the same exchange serves both joins
    docs = docs.groupBy("kid", "text_hash").agg(F.first("text").alias("text"))

    def sketch(column: str) -> Column:
        return bottom_k(shingle_hashes(F.col(column), size), k)

    heads = (docs.join(links, ["kid", "text_hash"])
             .select("doc_id", "n_chars", "to_kid", "to_hash", F.substring("text", F.lit(1), half).alias("head"),
                     words(F.col("text")).alias("next_words"))
             .select("doc_id", "n_chars", F.col("to_kid").alias("kid"), F.col("to_hash").alias("text_hash"), "head",
                     sketch("next_words").alias("next_sketch")))
    edited = F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")), F.col("head"))
    return (docs.join(heads, ["kid", "text_hash"])
            .select("doc_id", "kid", "text_hash", "n_chars", words(F.col("text")).alias("own_words"),
                    edited.alias("edited"), "next_sketch")
            .withColumn("edited_words", words(F.col("edited")))
            .select("doc_id", "kid", "text_hash", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                    sketch("own_words").alias("sketch"), sketch("edited_words").alias("edited_sketch"), "next_sketch"))


def fingerprint_digest(pairs: DataFrame, k: int = K) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next), one row per distinct (id, text)."""
    out = pairs.select(
        "doc_id", "kid", "text_hash", "n_chars", "edited_sha256",
        to_text(F.col("sketch")).alias("fingerprint"), to_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"))
    # the join above is partitioned and sorted by the key: no further shuffle or sort
    return out.dropDuplicates(["kid", "text_hash"]).drop("kid", "text_hash")
