"""Near-duplicate groups by one-permutation MinHash.

A document's set is its distinct word shingles, as 64-bit hashes.

1. *Classes*: documents with equal sets form a class (a partial aggregate on a
   128-bit digest of the set). From here on a class is one node, however many
   copies it has.
2. *Signatures*: one hash of each shingle puts it into one of ``bands * rows``
   bins by its high bits; a bin keeps its smallest hash. Empty bins are filled
   by optimal densification: bin ``i`` takes the value of the first filled bin
   in its own fixed random order of the bins.
3. *Buckets*: ``rows`` consecutive bins make a band key. A pair at similarity
   0.75 misses all 64 buckets with probability 4e-6.
4. *Stars*: in each bucket only edges from a hub are made, the hub being the
   member that meets most others over all its buckets. They are confirmed on
   the full sets, and confirmed edges are contracted to components.
5. *Rest*: a bucket whose members still lie in two or more components is open.
   Its members meet once more by an exact prefix filter: a set's shingles are
   ordered from the rarest to the most frequent one, and a similar pair must share
   one among the first ``n - ceil(0.75 n) + 1`` of both, at places that leave enough
   shingles behind them. Only pairs of different components are made, a frequent
   shingle's holders are dealt to many tasks, and no place is given in a bucket. What
   documents share with many others comes last in this order, so documents that
   have a passage or a template in common without being similar do not meet.

Nothing is collected to the driver but row counts. Every step is written to the
shared folder, so lost executors recompute one step at most.

Edge cases: null or empty text, or no word: an empty set, linked with nothing,
its own component. Fewer words than a shingle: the whole sequence is one
shingle. Repeated rows are separate rows of one class. Rows without an id take
part; a component's id is its smallest id that is not null. An empty table
gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playstats.llm.common import handed_on, id_text, stored, text_chunks, with_row
from playstats.llm.textops import gram_hashes, mix, words_of

SHINGLE_WORDS = 5
BANDS, ROWS = 64, 6
SIMILAR_PERCENT = 75
#: Holders of a shingle that one task joins with the others.
CELL = 4096


@functools.cache
def _orders(bins: int) -> tuple[np.ndarray, np.ndarray]:
    """For every bin a fixed random order of all bins, and each bin's rank in it."""
    h = mix(np.arange(bins * bins, dtype=np.uint64) + np.uint64(0x5151))
    order = np.argsort(h.reshape(bins, bins), axis=1).astype(np.int32)
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(bins, dtype=np.int32)[None, :].repeat(bins, 0), axis=1)
    return order, rank


def signature(shingles: np.ndarray, bins: int) -> np.ndarray:
    """Densified one-permutation signature of a sorted, non-empty set of hashes."""
    bin_of = ((shingles >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    filled, first = np.unique(bin_of, return_index=True)  # sorted hashes: the first is the smallest
    values = np.zeros(bins, np.uint64)
    values[filled] = shingles[first]
    if len(filled) == bins:
        return values
    have = np.zeros(bins, bool)
    have[filled] = True
    order, rank = _orders(bins)
    source = np.arange(bins)
    todo = np.flatnonzero(~have)
    for probe in range(8):  # most bins find a filled one in a few probes ...
        at = order[todo, probe]
        hit = have[at]
        source[todo[hit]] = at[hit]
        todo = todo[~hit]
        if not len(todo):
            break
    if len(todo):  # ... the rest take the filled bin of the lowest rank, the same choice
        source[todo] = filled[np.argmin(rank[np.ix_(todo, filled)], axis=1)]
    return values[source]


def band_keys(values: np.ndarray, bands: int, rows: int) -> np.ndarray:
    table = values.reshape(bands, rows)
    places = mix(np.arange(11, 11 + rows, dtype=np.uint64)) | np.uint64(1)
    return mix((table * places).sum(axis=1, dtype=np.uint64) + mix(np.arange(bands, dtype=np.uint64)))


def shingle_sets(texts: list[str], size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words, first = words_of(texts)
    return [np.unique(gram_hashes(words[a:b], size)) for a, b in zip(first[:-1], first[1:])]


def _profiles(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, n_shingles, digest, keys), and the row handed on: keys are null for an
    empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_chunks(batches):
            sets = shingle_sets(texts, size)
            keys = [band_keys(signature(s, bands * rows), bands, rows).view(np.int64) if len(s) else None
                    for s in sets]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([_digest(s) for s in sets], pa.binary()),
                 pa.array(keys, pa.list_(pa.int64())), *part.columns[2:]],
                names=["doc_id", "n_shingles", "digest", "keys", *part.schema.names[2:]])

    return docs.mapInArrow(run, with_row(
        "doc_id bigint, n_shingles bigint, digest binary, keys array<bigint>", docs))


def _sets(docs: DataFrame, size: int) -> DataFrame:
    """(node, shingles) of rows (node, digest, text), those whose text has the digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_chunks(batches):
            sets = shingle_sets(texts, size)
            same = pa.array([_digest(s) == d for s, d in zip(sets, part.column("digest").to_pylist())])
            yield pa.RecordBatch.from_arrays(
                [part.column("node"), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                names=["node", "shingles"]).filter(same)

    # an id may stand for several texts, or a text be there twice: one row per node
    return (docs.mapInArrow(run, "node bigint, shingles array<bigint>")
            .groupBy("node").agg(F.first("shingles").alias("shingles")))


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def components(links: DataFrame, label: str) -> DataFrame:
    """(node, component) for every node of the links (a, b): the smallest node that
    is reachable. Labels spread to neighbours and jump to their label's label
    until none changes."""
    both = stored(links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))),
                  f"{label}-edges")
    labels = stored(both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("node"), F.least("a", "m").alias("component")), f"{label}-labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), "component"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near")))
        nearer = labels.join(near, "node").select("node", "component",
                                                  F.least("component", "near").alias("next"))
        up = labels.select(F.col("node").alias("next"), F.col("component").alias("top"))
        moved = stored(nearer.join(up, "next").select("node", F.least("next", "top").alias("component"),
                                                      F.col("component").alias("was")), f"{label}-labels")
        labels = moved.select("node", "component")
        if moved.filter("component <> was").isEmpty():
            return labels


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int, label: str) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union of their full sets."""
    a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return stored(pairs.join(a, "a").join(b, "b")
                  .filter(100 * both >= percent * (F.size("sa") + F.size("sb") - both))
                  .select("a", "b"), label)


def near_duplicates(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = SHINGLE_WORDS, percent: int = SIMILAR_PERCENT,
                    bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row."""
    # names a text even where ids are null or repeated
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    key = F.unhex(F.md5(F.concat(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")), F.lit(":"), text)))
    keyed = documents.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("text"), key.alias("row"))
    profiles, named = _components(keyed, "doc_id", "text", shingle_words, percent, bands, rows, "row")
    linked = profiles.select("doc_id", "n_shingles", "digest").join(named, "digest", "left")
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return linked.select("doc_id", "n_shingles", own.alias("component_id"),
                         F.col("doc_id").eqNullSafe(own).alias("kept"))


def one_of_each(documents: DataFrame, row_key: str, id_col: str = "doc_id", text_col: str = "text",
                shingle_words: int = SHINGLE_WORDS, percent: int = SIMILAR_PERCENT,
                bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(row): the ``row_key`` of one row of each component, that with the smallest id,
    null last, then the smallest key; and of every row with an empty set. Unlike
    ids, which may be null or stand for several texts, a key names one row or equal
    rows."""
    profiles, named = _components(documents, id_col, text_col, shingle_words, percent, bands, rows, row_key)
    full = profiles.filter("n_shingles > 0").groupBy("digest").agg(_least_row())
    best = (full.select("digest", "least.*").join(named, "digest").groupBy("component").agg(_least_row())
            .select("least.row"))
    return best.unionAll(profiles.filter("n_shingles = 0").select("row").distinct())


def _least_row() -> Column:
    return F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("least")


def _components(documents: DataFrame, id_col: str, text_col: str, shingle_words: int, percent: int, bands: int,
                rows: int, row_key: str) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n_shingles, digest, keys, row) of every row, ``row`` being its ``row_key``,
    and (digest, component, component_id) of every class."""
    docs = id_text(documents, id_col, text_col, *handed_on(row_key))
    profiles = stored(_profiles(docs, shingle_words, bands, rows), "minhash-profiles")
    classes = stored(
        profiles.filter("n_shingles > 0").groupBy("digest")
        .agg(F.min("doc_id").alias("first_id"), F.first("n_shingles").alias("n"), F.first("keys").alias("keys"),
             F.min("row").alias("of"))
        .withColumn("node", F.monotonically_increasing_id()), "minhash-classes")

    buckets = classes.select("node", "n", F.explode("keys").alias("key"))
    shared = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    members = stored(buckets.join(shared, "key"), "minhash-members")
    meets = members.groupBy("node").agg(F.sum("members").alias("meets"))
    members = stored(members.join(meets, "node").select("key", "node", "n", "meets"), "minhash-buckets")

    # full sets of the classes that meet another one: from one text of each class
    one = classes.join(members.select("node").distinct(), "node", "left_semi").select("node", "digest", "of")
    of = docs.join(one, docs["row"] == one["of"]).select("node", "digest", "text")
    sets = stored(_sets(of, shingle_words), "minhash-sets")

    hub = members.groupBy("key").agg(F.max(F.struct("meets", -F.col("node"), "n")).alias("h")).select(
        "key", (-F.col("h.col2")).alias("b"), F.col("h.n").alias("nb"))
    pairs = (members.join(hub, "key").filter((F.col("node") != F.col("b")) & _alike("n", "nb", percent))
             .select(F.col("node").alias("a"), "b").distinct())
    links = _confirmed(stored(pairs, "minhash-pairs"), sets, percent, "minhash-links")
    labels = members.select("node").distinct().join(components(links, "minhash"), "node", "left").select(
        "node", F.coalesce("component", "node").alias("component"))
    labels = stored(labels, "minhash-labels")
    rest = stored(_open(members, labels), "minhash-open")
    if not rest.isEmpty():
        pairs = stored(_prefix_pairs(rest, sets, percent), "minhash-pairs")
        found = _confirmed(pairs, sets, percent, "minhash-links")
        if not found.isEmpty():
            labels = _joined(labels, found)

    # a component's id is the smallest document id in it
    named = classes.select("node", "digest", "first_id").join(labels, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    names = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    return profiles, stored(named.join(names, "component").select("digest", "component", "component_id"),
                            "minhash-names")


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels after more links: components over the components they connect."""
    ends = [labels.select(F.col("node").alias(x), F.col("component").alias(f"c{x}")) for x in ("a", "b")]
    between = links.join(ends[0], "a").join(ends[1], "b").select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct()
    up = components(between, "minhash").select(F.col("node").alias("component"), F.col("component").alias("top"))
    return stored(labels.join(up, "component", "left").select("node", F.coalesce("top", "component").alias("component")),
                  "minhash-labels")


def _alike(a: str, b: str, percent: int) -> Column:
    """Sizes that allow the similarity."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(node, n, component) of the members of buckets that lie in several components."""
    rows = members.select("key", "node", "n").join(labels, "node")
    mixed = rows.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter(
        "lo <> hi").select("key")
    return rows.join(mixed, "key", "left_semi").select("node", "n", "component").distinct()


def _prefix_pairs(nodes: DataFrame, sets: DataFrame, percent: int, cell: int = CELL) -> DataFrame:
    """Distinct pairs (a, b) of nodes (node, n, component) of different components,
    among them every one that has the similarity."""
    each = sets.join(nodes, "node").select("node", "n", "component", F.explode("shingles").alias("shingle"))
    held = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("held")).filter("held > 1")
    # places in the order of rarity; shingles that no other node has come first and need not be kept
    shared = each.join(held, "shingle").groupBy("node", "n", "component").agg(
        F.sort_array(F.collect_list(F.struct("held", "shingle"))).alias("shared"))
    length = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    prefix = stored(shared.withColumn("first", F.col("n") - F.size("shared"))
                    .withColumn("shared", F.slice("shared", F.lit(1), F.greatest(F.lit(0), length - F.col("first")).cast("int")))
                    .select("node", "n", "component", "first", F.posexplode("shared").alias("i", "t"))
                    .select("node", "n", "component", (F.col("first") + F.col("i")).alias("at"), F.col("t.shingle").alias("shingle")),
                    "minhash-prefixes")
    # of a shingle's components the one with most holders meets only the others, not itself
    share = prefix.groupBy("shingle", "component").agg(F.count(F.lit(1)).alias("k"))
    facts = (share.groupBy("shingle").agg(F.sum("k").alias("holders"), F.count(F.lit(1)).alias("parts"),
                                          F.max(F.struct("k", "component")).alias("most"))
             .filter("parts > 1").select("shingle", F.col("most.component").alias("major"),
                                         F.ceil(F.col("holders") / cell).cast("int").alias("cells")))
    known = stored(prefix.join(facts, "shingle"), "minhash-meeting")
    # a frequent shingle's holders lie in cells; the others come to each of them
    one = known.filter(F.col("component") != F.col("major")).select(
        "shingle", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("cell"), F.col("node").alias("a"), F.col("n").alias("na"),
        F.col("at").alias("pa"), F.col("component").alias("ca"))
    two = known.select("shingle", F.pmod(F.xxhash64("node"), F.col("cells")).cast("int").alias("cell"), F.col("node").alias("b"),
                       F.col("n").alias("nb"), F.col("at").alias("pb"), F.col("component").alias("cb"), "major")
    # two that are both outside the major component meet once
    once = (F.col("cb") == F.col("major")) | (F.col("a") < F.col("b"))
    # from the first shingle in common on, the rest of both must hold the whole intersection
    behind = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb")) * (100 + percent) >= (F.col("na") + F.col("nb")) * percent
    return (one.join(two, ["shingle", "cell"])
            .filter((F.col("ca") != F.col("cb")) & once & _alike("na", "nb", percent) & behind)
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
