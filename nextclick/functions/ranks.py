"""Rank expressions that Spark has no single function for."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def average_rank(partition: str | list[str], order: str) -> Column:
    """Ties share the mean of the positions they span (pandas' default
    ``rank()``): ``(first + last) / 2``, where ``last`` counts the rows
    up to and including the peers. One window spec, one sort."""
    w = W.partitionBy(partition).orderBy(order)
    last = F.count(F.lit(1)).over(w.rangeBetween(W.unboundedPreceding, W.currentRow))
    return (F.rank().over(w) + last) / F.lit(2.0)
