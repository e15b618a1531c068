"""Comparison-friendly renderings of lists, times and doubles, shared by
the query catalog (the SQL oracle renders the same way)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TIME_FMT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
DIGITS = 6


def time_str(c: Column | str) -> Column:
    return F.date_format(F.col(c) if isinstance(c, str) else c, TIME_FMT)


def list_str(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.array_join(c.cast("array<string>"), ",")


def time_list_str(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.array_join(F.transform(c, lambda t: F.date_format(t, TIME_FMT)), ",")


def num(c: Column | str, digits: int = DIGITS) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), digits)
