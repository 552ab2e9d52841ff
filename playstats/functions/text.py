"""Small text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def full_name(first: Column | str, last: Column | str, sep: str = " ") -> Column:
    """``first || ' ' || last``: NULL when either part is NULL (not concat_ws)."""
    f = F.col(first) if isinstance(first, str) else first
    l_ = F.col(last) if isinstance(last, str) else last
    return F.concat(f, F.lit(sep), l_)
