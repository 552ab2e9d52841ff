"""Sorts, limits, top-k, head/tail and positional slices.

A limit here is always a feature of the query (a top-k report, a sample of n
rows) and always follows a total order, so the result is reproducible. Small
ordered limits plan as ``TakeOrderedAndProject`` (per-task top-k, then merge); a
slice finds its ends by selection instead of a global offset, which would pull
every row before its end into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

def _order(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in cols]


def top_k(df: DataFrame, k: int, order_by: Sequence[str | Column]) -> DataFrame:
    return df.orderBy(*_order(order_by)).limit(k)


def limit_n(df: DataFrame, n: int, order_by: Sequence[str | Column]) -> DataFrame:
    """``SELECT ... LIMIT n`` made reproducible by a total order."""
    return top_k(df, n, order_by)


def _reverse(cols: Sequence[str | Column]) -> list[Column]:
    out = []
    for c in cols:
        if not isinstance(c, str):
            raise TypeError("tail() needs column names to reverse the order")
        out.append(F.col(c).desc_nulls_first())
    return out


def head(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    return top_k(df, n, order_by)


def tail(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """Last ``n`` rows of the order: reversed order + limit."""
    return df.orderBy(*_reverse(order_by)).limit(n)


def head_tail(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """First ``n`` and last ``n`` rows (a row in both appears twice, as a
    concatenation of the two frames would)."""
    return head(df, n, order_by).unionByName(tail(df, n, order_by))


#: Sampled keys of one round of a selection, and rows that one task may sort.
PIVOTS, SORT_ROWS = 64, 50_000


class _Place:
    """Order of whole rows: by ``order_by`` (NULL last), then by the other columns, so
    rows that tie on everything are alike. A row's key is the tuple of its values."""

    def __init__(self, df: DataFrame, order_by: Sequence[str]):
        names = [*order_by, *[c for c in df.columns if c not in order_by]]
        self.types = [df.schema[n].dataType for n in names]
        # an instant as a number, so that no time zone comes in between
        self.values = [F.unix_micros(F.col(f"`{n}`")) if isinstance(t, T.TimestampType) else F.col(f"`{n}`")
                       for n, t in zip(names, self.types)]
        self.row = F.struct(*[x for v in self.values for x in (v.isNull(), v)])

    def order(self) -> list[Column]:
        return [v.asc_nulls_last() for v in self.values]

    def keys(self, rows: DataFrame) -> DataFrame:
        """The keys in a form that the driver hands back unchanged."""
        return rows.select(*[(v.cast("string") if isinstance(t, T.TimestampNTZType) else v).alias(f"_{i}")
                             for i, (v, t) in enumerate(zip(self.values, self.types))])

    def _literals(self, key: tuple) -> list[Column]:
        return [F.lit(v).cast("long" if isinstance(t, T.TimestampType) else t) for v, t in zip(key, self.types)]

    def below(self, key: tuple) -> Column:
        """Rows before the first one with this key."""
        return self.row < F.struct(*[x for v, lit in zip(key, self._literals(key)) for x in (F.lit(v is None), lit)])

    def equal(self, key: tuple) -> Column:
        cond = F.lit(True)
        for v, lit in zip(self.values, self._literals(key)):
            cond = cond & v.eqNullSafe(lit)
        return cond

    def between(self, df: DataFrame, low: tuple | None, high: tuple | None) -> DataFrame:
        """Rows from key ``low`` (included) to ``high``; None: no bound. The bounds of the
        first column stand by themselves, so that the scan can skip by them."""
        if low is not None:
            df = df.filter(~self.below(low))
            if low[0] is not None:
                df = df.filter((self.values[0] >= self._literals(low)[0]) | self.values[0].isNull())
        if high is not None:
            df = df.filter(self.below(high))
            if high[0] is not None:
                df = df.filter(self.values[0] <= self._literals(high)[0])
        return df


def _range_counts(df: DataFrame, place: _Place, keys: list[tuple]) -> list[int]:
    """Rows before the first key, from each key to the next, and from the last one on."""
    # a row falls into the first range whose end is behind it; a counter for each range
    number = F.when(place.below(keys[0]), F.lit(0))
    for i, k in enumerate(keys[1:], 1):
        number = number.when(place.below(k), F.lit(i))
    counts = {r[0]: r[1] for r in df.groupBy(number.otherwise(F.lit(len(keys))).alias("_r")).agg(F.count(F.lit(1))).collect()}
    return [counts.get(i, 0) for i in range(len(keys) + 1)]


class _Range:
    """Rows from key ``low`` (included; None: the first) to key ``high`` (None: the end);
    ``start`` rows come before, ``n`` are inside."""

    def __init__(self, low, high, start: int, n: int):
        self.low, self.high, self.start, self.n = low, high, start, n

    def of(self, df: DataFrame, place: _Place) -> DataFrame:
        return place.between(df, self.low, self.high)


def _pivots(rows: DataFrame, place: _Place, n: int, turn: int, many: int) -> list[tuple]:
    """About ``many`` distinct keys, chosen by their hash, in order."""
    share = min(1.0, many / n)
    luck = F.xxhash64(F.lit(turn), *place.values).bitwiseAND(F.lit((1 << 53) - 1))
    # the draw is by key, so repeated rows are drawn or left out together
    drawn = rows.filter(luck < F.lit(int(share * (1 << 53)))).distinct().orderBy(*place.order())
    return [tuple(r) for r in place.keys(drawn).collect()]


def _locate(df: DataFrame, place: _Place, at: int, within: _Range, pivots: int, sort_rows: int) -> _Range:
    """The range, of ``sort_rows`` rows at most or of one repeated row, that holds position ``at``."""
    turn = 0
    while within.n > sort_rows:
        rows = within.of(df, place)
        keys = [k for k in _pivots(rows, place, within.n, turn, pivots) if k != within.low]
        if not keys:
            # the draw missed, or one row fills the range: cut behind the first key
            first = tuple(place.keys(rows.orderBy(*place.order()).limit(1)).first())
            rest = place.keys(rows.filter(~place.equal(first)).orderBy(*place.order()).limit(1)).collect()
            if not rest:
                return within
            keys = [tuple(rest[0])]
        turn += 1
        start = within.start
        for low, high, n in zip([within.low, *keys], [*keys, within.high], _range_counts(rows, place, keys)):
            if at < start + n:
                within = _Range(low, high, start, n)
                break
            start += n
    return within


def _take(df: DataFrame, place: _Place, r: _Range, skip: int, take: int, sort_rows: int) -> DataFrame:
    """Rows number ``skip`` to ``skip + take`` of a range."""
    rows = r.of(df, place)
    if skip <= 0 and take >= r.n:
        return rows
    if r.n <= sort_rows:
        return rows.orderBy(*place.order()).offset(skip).limit(take)
    # one row, repeated: any of its copies will do
    one = rows.limit(1)
    return one.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(take).cast("long")))).drop("_copy")


def slice_rows(df: DataFrame, order_by: Sequence[str], start: int, stop: int | None = None,
               pivots: int = PIVOTS, sort_rows: int = SORT_ROWS) -> DataFrame:
    """Rows ``start <= position < stop`` of the order (``stop=None``: to the end), NULL
    last, ties by the other columns. The result itself is in no order.

    The ends of the slice are found by selection: sampled keys cut the table into
    ranges, the rows of each are counted, and only the range that holds an end is cut
    again, until it has at most ``sort_rows`` rows. Those are sorted; the ranges between
    the ends are taken as they are, the ones outside are filtered out. Nothing is
    stored or exchanged but the counts, the sampled keys and the two last ranges.
    Columns that have no order (maps) are refused, as by any sort."""
    if start < 0 or (stop is not None and stop < 0):
        raise ValueError("positions start at 0")
    place = _Place(df, list(order_by))
    n = df.count()
    stop = n if stop is None else min(stop, n)
    if start >= stop:
        return df.limit(0)
    whole = _Range(None, None, 0, n)
    first = _locate(df, place, start, whole, pivots, sort_rows) if start > 0 else None
    last = _locate(df, place, stop - 1, whole, pivots, sort_rows) if stop < n else None
    if first is None and last is None:
        return df
    if first is not None and last is not None and (first.start, first.n) == (last.start, last.n):
        return _take(df, place, first, start - first.start, stop - start, sort_rows)
    begin, end = (first.start + first.n if first else 0), (last.start if last else n)
    out = []
    if first is not None:
        out.append(_take(df, place, first, start - first.start, first.start + first.n - start, sort_rows))
    if begin < end:
        out.append(place.between(df, first.high if first else None, last.low if last else None))
    if last is not None:
        out.append(_take(df, place, last, 0, stop - last.start, sort_rows))
    rows = out[0]
    for more in out[1:]:
        rows = rows.unionByName(more)
    return rows


def share_percent(df: DataFrame, count_col: str, name: str = "share_percent") -> DataFrame:
    """Integer percent of each row's count within ``df`` (a top-k result, so a
    handful of rows), rounded half to even like C ``%1.0f``."""
    # a window over the whole (k-row) result: the top-k is computed once
    total = F.sum(count_col).over(Window.partitionBy())
    return df.withColumn(name, F.bround(F.col(count_col) * 100.0 / total, 0).cast("int"))
