"""Skew-safe equi-join of a large frame with a frame that is unique per key.

A key may hold a large share of the big side's rows (one song played a third
of the time, one very active user, or NULL). A plain sort-merge join sends all
those rows to one task. Here:

1. hot keys = keys with more than ``rows_per_bucket`` rows, found by one partial
   aggregate and stored once. There is no limit on their number: at most
   ``rows / rows_per_bucket`` keys can be hot.
2. A hot key is spread over ``ceil(rows / rows_per_bucket)`` buckets, whatever
   its size. Without any hot key the join is a plain one.
3. Big-side rows of hot keys get a salt in ``[0, buckets)``, a hash of the
   row's content. It is deterministic, so a recomputed task salts exactly as
   before. All other rows get salt 0. Fully identical rows share a salt;
   callers whose big side can repeat rows reduce it to (row, copies) first
   (see ``operators.keys.groups_larger_than``).
4. Small-side rows of hot keys are replicated once per bucket, which adds at
   most ``rows / rows_per_bucket`` rows, because the small side is unique per key.
5. One join on ``keys + salt`` spreads each hot key over its buckets. No row is
   dropped or sampled.

Whether the small side or the hot-key table is broadcast is the planner's
choice, by their sizes in bytes; if the hot-key table is itself large, it is
joined by a shuffle in which AQE splits the skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playstats.scratch import stored

SALT = "_salt"
ROWS_PER_BUCKET = 1_000_000


def hot_keys(big: DataFrame, keys: Sequence[str], rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Every key (NULL included) with more than ``rows_per_bucket`` rows, and the
    number of buckets ``_buckets`` it needs."""
    return (big.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
            .filter(F.col("_n") > rows_per_bucket)
            .select(*keys, F.ceil(F.col("_n") / F.lit(float(rows_per_bucket))).cast("long").alias("_buckets")))


def planner_broadcasts(small: DataFrame) -> bool:
    """Is the frame's size, as the planner estimates it, below its broadcast threshold? A
    broadcast join moves no row of the other side, so it needs no care for hot keys."""
    query = small._jdf.queryExecution()
    limit = query.sparkSession().sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(query.optimizedPlan().stats().sizeInBytes())) <= limit


def _match(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], null_safe: bool):
    cond = None
    for lcol, rcol in pairs:
        e = left[f"`{lcol}`"].eqNullSafe(right[rcol]) if null_safe else left[f"`{lcol}`"] == right[rcol]
        cond = e if cond is None else cond & e
    return cond


def skew_safe_join(big: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "left",
                   null_safe: bool = False, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """``big.join(small, keys, how)`` for ``small`` unique per ``keys``, with
    hot keys of ``big`` spread over several tasks each. Output columns are
    those of the plain using-join (big's columns, then small's non-key
    columns; big's only for semi/anti). ``null_safe=True`` matches NULL keys
    to NULL keys (``<=>``), as grouping does; otherwise they match nothing and
    are only spread."""
    if how == "left_outer":
        how = "left"
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError("skew_safe_join keeps every big-side row once: left/inner/semi/anti only")
    keys = list(keys)
    sk = [f"_sk{i}" for i in range(len(keys))]
    hk = [f"_hk{i}" for i in range(len(keys))]
    rest = [c for c in small.columns if c not in keys]
    s = small.select(*[F.col(f"`{k}`").alias(x) for k, x in zip(keys, sk)], *[F.col(f"`{c}`") for c in rest])
    b = big
    hot = stored(hot_keys(big, keys, rows_per_bucket)
                 .select(*[F.col(f"`{k}`").alias(h) for k, h in zip(keys, hk)], "_buckets"), "hot-keys")
    salted = not hot.isEmpty()
    if salted:
        content = [F.col(f"`{c}`") for c in big.columns]
        # deterministic (content only), so a retried task salts every row the same
        # way and the shuffle is not marked indeterminate
        salt = F.coalesce(F.pmod(F.xxhash64(*content), F.col("_buckets")), F.lit(0).cast("long"))
        b = big.join(hot, _match(big, hot, list(zip(keys, hk)), True), "left").select(*content, salt.alias(SALT))
        fan = F.sequence(F.lit(0).cast("long"), F.coalesce(F.col("_buckets"), F.lit(1).cast("long")) - 1)
        s = (s.join(hot, _match(s, hot, list(zip(sk, hk)), True), "left")
             .select(*sk, *rest, F.explode(fan).alias("_ssalt")))
    cond = _match(b, s, list(zip(keys, sk)), null_safe)
    if salted:
        cond = cond & (b[SALT] == s["_ssalt"])
    out = b.join(s, cond, how)
    if how in ("left_semi", "left_anti"):
        return out.drop(SALT)
    return out.select(*[b[f"`{c}`"] for c in big.columns], *[s[f"`{c}`"] for c in rest])
