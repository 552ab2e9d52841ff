"""Epoch milliseconds -> start_time (second precision) -> calendar parts.

Everything uses TIMESTAMP_NTZ arithmetic, so results do not depend on the
session time zone (no DST gaps, no shift on cast).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_ms_to_start_time(ms: Column | str) -> Column:
    """UTC wall time of an epoch-millisecond value, floored to the second
    (also before 1970: -1500 ms -> 1969-12-31 23:59:58)."""
    m = _c(ms)
    secs = ((m - F.pmod(m, F.lit(1000))) / F.lit(1000)).cast("decimal(18,6)")
    return F.expr(_EPOCH) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs)


def floor_to_second(ts: Column | str) -> Column:
    """Drop the fraction of a second from a TIMESTAMP_NTZ value."""
    t = _c(ts)
    sec = F.extract(F.lit("SECOND"), t)
    return t - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), sec - F.floor(sec))


def ntz_to_epoch_ms(ts: Column | str) -> Column:
    """Milliseconds since 1970-01-01 of a TIMESTAMP_NTZ value.

    Built from calendar parts (days since the epoch date plus time of day),
    which are zone-free for NTZ; ``timestampdiff`` on NTZ values would pass
    through the session zone and move by an hour across DST changes."""
    t = _c(ts)
    days = F.date_diff(t.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    sec = F.extract(F.lit("SECOND"), t)
    ms_of_day = (F.hour(t).cast("long") * 3_600_000 + F.minute(t).cast("long") * 60_000
                 + F.floor(sec * 1000).cast("long"))
    return days * 86_400_000 + ms_of_day


def time_part_columns(ts: Column | str) -> dict[str, Column]:
    """hour, day, ISO week, month, year, weekday (Monday = 0), all INT."""
    t = _c(ts)
    return {
        "hour": F.hour(t).cast("int"),
        "day": F.dayofmonth(t).cast("int"),
        "week": F.weekofyear(t).cast("int"),
        "month": F.month(t).cast("int"),
        "year": F.year(t).cast("int"),
        "weekday": F.weekday(t.cast("date")).cast("int"),
    }


def add_time_parts(df: DataFrame, ts_col: str = "start_time") -> DataFrame:
    return df.withColumns(time_part_columns(ts_col))
