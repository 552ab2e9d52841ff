"""Trie of conversation prefixes, built as a burst trie.

A conversation is a sequence of turns, a turn is known by the digest of (role,
text), and a node is a distinct sequence of first turns. Suffixes lie in
containers below trie heads:

1. At first one container below the root holds all conversations. A container
   with more than ``limit`` turns bursts: its suffixes go to one container for each
   next turn id, and the old container's place becomes a head. Sizes are counted
   by a grouping that is reduced before the shuffle, so a container of any size
   may burst. A pass bursts twice as many levels as the one before, so a long
   passage that many conversations share, or one very long conversation, takes few
   passes.
2. The containers that remain hold at most ``limit`` turns. They are dealt to the
   tasks, each one's suffixes sorted, and one sweep over the sorted suffixes emits
   its nodes with their counts.
3. A head's sums over its subtree come from the containers and heads below it. Each
   is credited to its smallest member, whose path leads through all its ancestors.

A long conversation is kept in segments of ``SEGMENT`` turns. The path of a head is
known by two 64-bit lanes over (place, turn id), which add up over segments.

Edge cases: null role or text is empty; turns are ordered by turn number, null
first, and among equal numbers by digest; a repeated row is a repeated turn; rows
without a conversation id belong to no conversation and are left out; a rebuilt
conversation may have no turns and then is a member of the root alone; an empty
table gives no nodes; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playstats.llm.common import stored

#: Turns (and ends) of a container; larger ones burst.
LIMIT = 4096

#: Turns in one segment of a conversation.
SEGMENT = 64

#: Rows of one key that a running sum orders in one task.
BLOCK = 4096

#: Conversation ids whose decimals are joined in one row.
ID_BLOCK = 4096

WORDS = r"[^\x20\x09-\x0D]+"

EMPTY_SHA = hashlib.sha256(b"").hexdigest()

_NODE = ("conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
         "saved_tokens bigint, ends_sha256 string, turn_md5 string")
_COLUMNS = [c.split()[0] for c in _NODE.split(", ")]


def turn_digest(role: Column, text: Column) -> Column:
    """32 hex digits for (role, text)."""
    return F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))


def ordered_turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(turns, runs): every turn (part, idx, conv_id, d, words), and for each
    conversation and part (part, conv_id, idx0, before, n): its first row there, its
    turns in the parts before, and all its turns. A conversation may span parts."""
    spark = conversations.sparkSession
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = stored(conversations.filter(F.col(f"`{conv_col}`").isNotNull())
                  .select(F.col(f"`{conv_col}`").cast("long").alias("conv_id"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
                          F.unhex(turn_digest(role, text)).alias("d"),
                          F.regexp_count(text, F.lit(WORDS)).cast("long").alias("words")), "turns")
    # the row number parts repeated rows, which are alike in all else
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("d"), F.col("_row")]
    turns = stored(rows.withColumn("_row", F.monotonically_increasing_id())
                   .repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order)
                   .sortWithinPartitions(*order)
                   .select(F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("idx"),
                           "conv_id", "d", "words"), "ordered-turns")
    runs = turns.groupBy("part", "conv_id").agg(F.min("idx").alias("idx0"), F.count("*").alias("k"))
    # one row for each part that a conversation touches
    own = Window.partitionBy("conv_id")
    before = own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return turns, runs.select("part", "conv_id", "idx0", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("before"),
                              F.sum("k").over(own).alias("n"))


def rebuilt_turns(conversations: DataFrame, **columns: str) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations) after rebuilding: conversation c begins with the first
    h = crc32(c) % 4 turns of conversation c - c % 20 (fewer, if that has fewer) and goes
    on with its own turns after its first h. Turns: (conv_id, pos, d, words), pos from
    0; conversations: (conv_id, length)."""
    turns, runs = ordered_turns(conversations, **columns)
    runs = stored(runs, "runs")
    base = F.pmod(F.col("conv_id"), F.lit(20)) == 0
    place = F.col("idx") - F.col("idx0") + F.col("before")
    # three rows at most for each
    heads = (turns.filter(base).join(runs.filter(base & (F.col("before") < 3)), ["part", "conv_id"])
             .withColumn("pos", place).filter("pos < 3")
             .groupBy(F.col("conv_id").alias("source"))
             .agg(F.sort_array(F.collect_list(F.struct("pos", "d", "words"))).alias("head")))
    convs = (runs.filter("before = 0").select("conv_id", "n")
             .withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4)
             .withColumn("source", F.expr("try_subtract(conv_id, pmod(conv_id, 20L))"))
             .join(heads, "source", "left")
             .withColumn("head", F.expr("slice(coalesce(head, array()), 1, int(h))"))
             .withColumn("m", F.size("head").cast("long"))
             .withColumn("length", F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))))
    convs = stored(convs.select("conv_id", "h", "m", "head", "length"), "conversations")
    own = (turns.join(runs.join(convs.select("conv_id", "h", "m"), "conv_id"), ["part", "conv_id"])
           .withColumn("at", place).filter(F.col("at") >= F.col("h"))
           .select("conv_id", (F.col("at") - F.col("h") + F.col("m")).alias("pos"), "d", "words"))
    given = (convs.select("conv_id", F.explode("head").alias("t"))
             .select("conv_id", F.col("t.pos").alias("pos"), F.col("t.d").alias("d"), F.col("t.words").alias("words")))
    return own.unionByName(given), convs.select("conv_id", "length")


def running(df: DataFrame, key: str, place: str, values: dict[str, tuple[str, str]], block: int = BLOCK) -> DataFrame:
    """``df`` with running values of each key's rows before this one, in the order of
    ``place`` (a number from 0): ``{new: (column, "xor" or "sum")}``. Rows are ordered in
    blocks of places, and the blocks' totals among themselves, so a key may have any
    number of rows."""
    fold = {"xor": F.bit_xor, "sum": F.sum}
    df = df.withColumn("_block", F.floor(F.col(place) / block))
    back = (Window.unboundedPreceding, -1)
    totals = df.groupBy(key, "_block").agg(*[fold[how](c).alias(f"_t_{new}") for new, (c, how) in values.items()])
    among = Window.partitionBy(key).orderBy("_block").rowsBetween(*back)
    totals = totals.select(key, "_block", *[F.coalesce(fold[how](f"_t_{new}").over(among), F.lit(0)).alias(f"_c_{new}")
                                            for new, (_, how) in values.items()])
    inside = Window.partitionBy(key, "_block").orderBy(place).rowsBetween(*back)

    def joined(new: str, c: str, how: str) -> Column:
        local = F.coalesce(fold[how](c).over(inside), F.lit(0))
        return local + F.col(f"_c_{new}") if how == "sum" else local.bitwiseXOR(F.col(f"_c_{new}"))

    return (df.join(totals, [key, "_block"])
            .select(*[c for c in df.columns if c != "_block"], *[joined(n, c, how).alias(n) for n, (c, how) in values.items()]))


def _lane(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col("pos"), F.col("d"))


def segments(turns: DataFrame) -> DataFrame:
    """Turns of a conversation by ``SEGMENT``: (conv_id, seg, items, s1, s2), where items
    are (pos, d, words, l1, l2) with the lanes of the path up to the turn inside the
    segment, and s1, s2 the lanes of all segments before."""
    turns = turns.withColumn("seg", F.floor(F.col("pos") / SEGMENT))
    upto = Window.partitionBy("conv_id", "seg").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    laned = turns.select("*", F.bit_xor(_lane(1)).over(upto).alias("l1"), F.bit_xor(_lane(2)).over(upto).alias("l2"))
    segs = laned.groupBy("conv_id", "seg").agg(
        F.sort_array(F.collect_list(F.struct("pos", "d", "words", "l1", "l2"))).alias("items"))
    last = F.element_at("items", -1)
    segs = stored(segs.select("conv_id", "seg", "items", last["l1"].alias("t1"), last["l2"].alias("t2")), "segments")
    return stored(running(segs, "conv_id", "seg", {"s1": ("t1", "xor"), "s2": ("t2", "xor")}).drop("t1", "t2"), "laned")


def _levels(active: DataFrame, segs: DataFrame, low: int, high: int) -> DataFrame:
    """The active conversations' nodes of depth low + 1 to high: (conv_id, length, depth,
    h1, h2, p1, p2, words, d): lanes of the node's path and of its parent's."""
    near = segs.filter((F.col("seg") * SEGMENT < high) & ((F.col("seg") + 1) * SEGMENT > low))
    each = (active.select("conv_id", "length").join(near, "conv_id")
            .select("conv_id", "length", "s1", "s2", F.explode("items").alias("t"))
            .select("conv_id", "length", "s1", "s2", "t.*").filter((F.col("pos") >= low) & (F.col("pos") < high)))
    each = each.withColumns({f"h{i}": F.col(f"s{i}").bitwiseXOR(F.col(f"l{i}")) for i in (1, 2)})
    return each.select("conv_id", "length", (F.col("pos") + 1).alias("depth"), "h1", "h2",
                       *[F.col(f"h{i}").bitwiseXOR(_lane(i)).alias(f"p{i}") for i in (1, 2)], "words", "d")


def burst(convs: DataFrame, segs: DataFrame, limit: int = LIMIT) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(heads, paths, ends, contained). heads: (h1, h2, depth, p1, p2, n, conv_id, words,
    d); paths: (conv_id, depth, h1, h2) of every conversation's heads below the root; ends:
    (h1, h2, conv_id) of conversations that end at a head; contained: (conv_id, depth, h1,
    h2, p1, p2) of the others' containers, depth being that of the container's top."""
    lanes = ["h1", "h2"]
    root = convs.agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id")).filter("n > 0").select(
        *[F.lit(0).cast("long").alias(c) for c in (*lanes, "depth")],
        *[F.lit(None).cast("long").alias(c) for c in ("p1", "p2")], "n", "conv_id",
        F.lit(0).cast("long").alias("words"), F.lit(None).cast("binary").alias("d"))
    heads, paths, contained = [root], [], []
    ends = [convs.filter("length = 0").select(*[F.lit(0).cast("long").alias(c) for c in lanes], "conv_id")]
    active, low, step = convs.filter("length > 0"), 0, 1
    while True:
        high = low + step
        levels = _levels(active, segs, low, high)
        large = stored(levels.groupBy(*lanes, "depth").agg(
            F.sum(F.col("length") - F.col("depth") + 1).alias("size"), F.first("p1").alias("p1"), F.first("p2").alias("p2"),
            F.count("*").alias("n"), F.min("conv_id").alias("conv_id"), F.first("words").alias("words"), F.first("d").alias("d"))
            .filter(F.col("size") > limit).drop("size"), "burst-heads")
        marked = stored(levels.drop("words", "d").join(
            large.select(*lanes, "depth", F.lit(True).alias("is_head")), [*lanes, "depth"], "left"), "burst-levels")
        # sizes fall with depth, so a conversation's heads are its first nodes
        top = F.when(F.col("is_head").isNull(), F.struct("depth", *lanes, "p1", "p2"))
        deepest = F.when(F.col("is_head"), F.struct("depth", *lanes))
        state = stored(marked.groupBy("conv_id").agg(F.first("length").alias("length"), F.max(deepest).alias("head"),
                                                     F.min(top).alias("top")), "burst-state")
        heads.append(large)
        paths.append(marked.filter("is_head").select("conv_id", "depth", *lanes))
        contained.append(state.filter("top IS NOT NULL").select("conv_id", "top.*"))
        ends.append(state.filter("top IS NULL AND head.depth = length").select("head.h1", "head.h2", "conv_id"))
        active = state.filter("top IS NULL AND head.depth < length").select("conv_id", "length")
        if active.isEmpty():
            return tuple(_all(x) for x in (heads, paths, ends, contained))
        low, step = high, 2 * step


def _all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


class _Sweep:
    """One container's suffixes, given in order, become its nodes."""

    def __init__(self, depth: int):
        self.depth, self.nodes, self.open, self.last = depth, [], [], []

    def add(self, conv: int, turns: list[bytes], words: list[int]) -> None:
        same, most = 0, min(len(turns), len(self.last))
        while same < most and turns[same] == self.last[same]:
            same += 1
        del self.open[same:]
        for i in range(same, len(turns)):
            self.nodes.append({"up": self.open[-1] if self.open else None, "depth": self.depth + i, "words": words[i],
                               "turn": turns[i], "conv": conv, "n": 0, "children": 0, "leaves": 0, "saved": 0, "ends": []})
            self.open.append(len(self.nodes) - 1)
        self.nodes[self.open[-1]]["ends"].append(conv)
        self.last = turns

    def rows(self) -> list[tuple]:
        nodes = self.nodes
        for node in reversed(nodes):  # children come after their parents
            node["n"] += len(node["ends"])
            node["conv"] = min([node["conv"], *node["ends"]])
            node["leaves"] = node["leaves"] or 1
            node["saved"] += (node["n"] - 1) * node["words"]
            if node["up"] is not None:
                up = nodes[node["up"]]
                up["n"] += node["n"]
                up["conv"] = min(up["conv"], node["conv"])
                up["children"] += 1
                up["leaves"] += node["leaves"]
                up["saved"] += node["saved"]
        return [(x["conv"], x["depth"], None if x["up"] is None else nodes[x["up"]]["conv"], x["n"], x["children"], x["leaves"],
                 x["saved"], hashlib.sha256(",".join(map(str, sorted(x["ends"]))).encode()).hexdigest(), x["turn"].hex())
                for x in nodes]


def sweep(contained: DataFrame, segs: DataFrame) -> DataFrame:
    """The nodes of all containers. A container's top has no ``parent_conv_id`` yet, but
    the lanes p1, p2 of its parent."""
    box = ["h1", "h2", "p1", "p2", "top"]
    part = F.filter("items", lambda t: t["pos"] >= F.col("top") - 1)
    suffixes = (contained.withColumnRenamed("depth", "top").join(segs, "conv_id")
                .filter((F.col("seg") + 1) * SEGMENT >= F.col("top"))
                .select("conv_id", *box, part.alias("items"))
                .groupBy("conv_id", *box).agg(F.sort_array(F.flatten(F.collect_list("items"))).alias("items"))
                .select(*box, "conv_id", F.col("items.d").alias("turns"), F.col("items.words").alias("words")))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, now, out = None, None, []

        def close() -> None:
            if now is not None:
                out.extend((*row, *(own[2:4] if row[2] is None else (None, None))) for row in now.rows())

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows))
            kinds = [*[pa.int64()] * 7, pa.string(), pa.string(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[*_COLUMNS, "p1", "p2"])

        for batch in batches:
            for *box_, conv, turns, words in zip(*[batch.column(c).to_pylist() for c in (*box, "conv_id", "turns", "words")]):
                if box_ != own:
                    close()
                    own, now = box_, _Sweep(box_[4])
                now.add(conv, turns, words)
                if len(out) > 20_000:
                    yield batch_of(out)
                    out.clear()
        close()
        if out:
            yield batch_of(out)

    return (suffixes.repartition("h1", "h2").sortWithinPartitions(*box, "turns", "conv_id")
            .mapInArrow(work, f"{_NODE}, p1 bigint, p2 bigint"))


def ends_digests(ends: DataFrame) -> DataFrame:
    """(h1, h2, ends_sha256) of (h1, h2, conv_id): the decimal ids, ascending, joined by
    commas. Ids are joined in blocks of ``ID_BLOCK`` id values wherever they are, and only
    the joined blocks go to the task that hashes them one after another."""
    blocks = (ends.groupBy("h1", "h2", F.floor(F.col("conv_id") / ID_BLOCK).alias("block"))
              .agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, state, out = None, None, []
        for batch in batches:
            for h1, h2, ids in zip(*[batch.column(c).to_pylist() for c in ("h1", "h2", "ids")]):
                if (h1, h2) == own:
                    state.update(b",")
                else:
                    if own is not None:
                        out.append((*own, state.hexdigest()))
                    own, state = (h1, h2), hashlib.sha256()
                state.update(ids.encode("ascii"))
        if own is not None:
            out.append((*own, state.hexdigest()))
        columns = list(zip(*out)) if out else [[], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())],
            names=["h1", "h2", "ends_sha256"])

    return (blocks.repartition("h1", "h2").sortWithinPartitions("h1", "h2", "block").select("h1", "h2", "ids")
            .mapInArrow(work, "h1 bigint, h2 bigint, ends_sha256 string"))


def prefix_trie(conversations: DataFrame, limit: int = LIMIT, rebuild: bool = True, **columns: str) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256 and turn_md5, the digest of its last
    (role, text) by :func:`turn_digest` (root: null)."""
    turns, convs = rebuilt_turns(conversations, **columns)
    segs = segments(turns)
    heads, paths, ends, contained = burst(convs, segs, limit)
    heads, swept = stored(heads, "heads"), stored(sweep(contained, segs), "swept")
    lanes = ["h1", "h2"]
    tops = swept.filter("p1 IS NOT NULL")
    children = (heads.filter("p1 IS NOT NULL").select("p1", "p2").unionByName(tops.select("p1", "p2"))
                .groupBy(F.col("p1").alias("h1"), F.col("p2").alias("h2")).agg(F.count("*").alias("n_children")))
    heads = stored(heads.join(children, lanes, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "heads2")
    # what a head gains by itself and by the containers hanging on it, at its smallest member's path
    gains = (heads.select("conv_id", "depth", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaves"),
                          ((F.col("n") - 1) * F.col("words")).alias("saved"))
             .unionByName(tops.select("conv_id", (F.col("depth") - 1).alias("depth"), F.col("n_leaves").alias("leaves"),
                                      F.col("saved_tokens").alias("saved")))
             .groupBy("conv_id", "depth").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")))
    gains = stored(gains, "gains")
    who = gains.groupBy("conv_id").agg(F.max("depth").alias("deepest"))
    root_path = who.select("conv_id", *[F.lit(0).cast("long").alias(c) for c in ("depth", *lanes)])
    path = (paths.join(who, "conv_id").filter("depth <= deepest").select("conv_id", "depth", *lanes).unionByName(root_path)
            .join(gains, ["conv_id", "depth"], "left").fillna(0, ["leaves", "saved"]))
    # below a head lies what is on its members' paths at its depth or deeper
    whole = path.groupBy("conv_id").agg(F.sum("leaves").alias("all_leaves"), F.sum("saved").alias("all_saved"))
    sums = (running(path, "conv_id", "depth", {"leaves_before": ("leaves", "sum"), "saved_before": ("saved", "sum")})
            .join(whole, "conv_id")
            .groupBy(*lanes).agg(F.sum(F.col("all_leaves") - F.col("leaves_before")).alias("n_leaves"),
                                 F.sum(F.col("all_saved") - F.col("saved_before")).alias("saved_tokens")))
    ups = heads.select(F.col("h1").alias("p1"), F.col("h2").alias("p2"), F.col("conv_id").alias("parent"))
    head_nodes = (heads.join(sums, lanes).join(ends_digests(ends), lanes, "left").join(ups, ["p1", "p2"], "left")
                  .select("conv_id", "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children",
                          "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"),
                          F.lower(F.hex("d")).alias("turn_md5")))
    swept = (swept.join(ups, ["p1", "p2"], "left")
             .withColumn("parent_conv_id", F.coalesce("parent_conv_id", "parent")))
    return head_nodes.select(*_COLUMNS).unionByName(swept.select(*_COLUMNS))


def node_turns(nodes: DataFrame, conversations: DataFrame, role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The nodes with the role and text of their last turn (root: null)."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    turns = conversations.select(turn_digest(role, text).alias("turn_md5"), role.alias("role"), text.alias("text"))
    return nodes.join(turns.groupBy("turn_md5").agg(F.first("role").alias("role"), F.first("text").alias("text")),
                      "turn_md5", "left")
