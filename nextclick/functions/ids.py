"""Prefixed string ids (``u_<n>``, ``v_<n>``) <-> integers, scalar and array."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_id(c: Column, prefix: str, strict: bool = True) -> Column:
    """Drop ``len(prefix)`` characters and read an integer. Strict mode fails
    on a malformed id, lenient mode gives NULL."""
    body = F.substring(c, len(prefix) + 1, 1 << 30)
    return body.cast("bigint") if strict else body.try_cast("bigint")


def build_id(c: Column, prefix: str) -> Column:
    return F.concat(F.lit(prefix), c.cast("string"))


def parse_id_array(c: Column, prefix: str, strict: bool = True) -> Column:
    return F.transform(c, lambda x: parse_id(x, prefix, strict))


def build_id_array(c: Column, prefix: str) -> Column:
    return F.transform(c, lambda x: build_id(x, prefix))
