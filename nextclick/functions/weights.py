"""Dictionary lookups of action codes (JVM map literal, no Python per row)."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Action code -> weight.
CONTINUE_SEARCH_WEIGHTS = {1: -5.0, 2: 1.0, 3: 3.0}
ALS_WEIGHTS = {1: 4.0, 2: 1.0, 3: 2.0}


def map_weight(c: Column, mapping: dict[int, float], strict: bool = True) -> Column:
    """Look ``c`` up in ``mapping``. An unknown code raises in strict mode
    and gives NULL otherwise (a NULL code stays NULL)."""
    lookup = F.create_map(*[F.lit(x) for x in chain.from_iterable(
        (int(k), float(v)) for k, v in mapping.items())])
    value = F.try_element_at(lookup, c.cast("int"))
    if not strict:
        return value
    return F.when(c.isNull() | value.isNotNull(), value).otherwise(
        F.raise_error(F.concat(F.lit("unknown action code "), c.cast("string"))))
