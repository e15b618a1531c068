"""Column expressions over a session's parallel arrays (JVM-side, codegen'd)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def equal_sizes(*cols: str) -> Column:
    first = F.size(cols[0])
    cond = F.lit(True)
    for c in cols[1:]:
        cond = cond & (F.size(c) == first)
    return cond


def checked(value: Column, *cols: str) -> Column:
    """``value`` when all arrays have one length, else a runtime error."""
    return F.when(equal_sizes(*cols), value).otherwise(
        F.raise_error(F.lit("parallel arrays differ in length: " + ", ".join(cols))))


def sorted_zip(order_col: str, other_cols: list[str]) -> Column:
    """One array of structs ``(k, p, c0, c1, ...)`` sorted by ``order_col``
    (``k``); the original position ``p`` breaks ties (a stable sort)."""
    cols = [order_col] + list(other_cols)
    zipped = F.transform(
        F.col(order_col),
        lambda x, i: F.struct(
            x.alias("k"), i.alias("p"),
            *[F.col(c)[i].alias(f"c{n}") for n, c in enumerate(other_cols)]))
    return checked(F.array_sort(zipped), *cols)


def unzip(zipped: str, order_col: str, other_cols: list[str]) -> dict[str, Column]:
    """Field arrays back out of a ``sorted_zip`` column."""
    out = {order_col: F.transform(F.col(zipped), _field("k"))}
    for n, c in enumerate(other_cols):
        out[c] = F.transform(F.col(zipped), _field(f"c{n}"))
    return out


def _field(name: str):
    return lambda s: s[name]


def last_element(col: str) -> Column:
    return F.try_element_at(F.col(col), F.lit(-1))


def all_but_last(col: str) -> Column:
    return F.slice(F.col(col), 1, F.greatest(F.size(col) - 1, F.lit(0)))


def first_match_struct(times: str, items: str, actions: str, code: int) -> Column:
    """Earliest ``(dt, item)`` among positions whose action equals ``code``;
    NULL when there is none."""
    pairs = F.transform(
        F.col(times),
        lambda t, i: F.struct(t.alias("dt"), F.col(items)[i].alias("item"), F.col(actions)[i].alias("act")))
    hits = F.filter(pairs, lambda s: s["act"] == code)
    return F.array_min(F.transform(hits, lambda s: F.struct(s["dt"].alias("dt"), s["item"].alias("item"))))
