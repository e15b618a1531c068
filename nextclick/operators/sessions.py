"""Session-log operators: normalisation (R1), per-item interactions (R37),
the reversible id codec (R30). All are narrow (no shuffle)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nextclick.functions.arrays import checked, sorted_zip, unzip
from nextclick.functions.ids import build_id, build_id_array, parse_id, parse_id_array

ARRAYS = ["vacancy_id", "action_type", "action_dt"]


def normalise_sessions(sessions: DataFrame, order_col: str = "action_dt",
                       other_cols: list[str] | None = None) -> DataFrame:
    """Sort each session's arrays by time (stable) and add ``session_dt``,
    the first time (NULL for an empty session)."""
    other_cols = other_cols or [c for c in ARRAYS if c != order_col]
    # Sort once into one struct array, then read fields from it: a filter
    # on session_dt pushed below this projection repeats one sort, not three.
    return (sessions.withColumn("_z", sorted_zip(order_col, other_cols))
                    .withColumns(unzip("_z", order_col, other_cols))
                    .withColumn("session_dt", F.get(F.col("_z"), F.lit(0))["k"])
                    .drop("_z"))


def interactions(sessions: DataFrame, keep: list[str] | None = None,
                 with_position: bool = True) -> DataFrame:
    """Zip-explode the parallel arrays to one row per interaction.

    An empty session gives one row of NULLs; arrays of unequal length raise.
    ``pos`` (1-based) keeps the in-session order for later tie-breaks."""
    keep = keep if keep is not None else [c for c in sessions.columns if c not in ARRAYS]
    zipped = F.transform(
        F.col("vacancy_id"),
        lambda v, i: F.struct(
            (i + 1).alias("pos"), v.alias("vacancy_id"),
            F.col("action_type")[i].alias("action_type"),
            F.col("action_dt")[i].alias("action_dt")))
    zipped = checked(zipped, *ARRAYS)
    out = sessions.select(*keep, F.inline_outer(zipped))
    return out if with_position else out.drop("pos")


class IdCodec:
    """Parse prefixed ids on the way in, rebuild them on the way out.

    ``columns`` maps a column to ``(prefix, is_array)``. ``decode`` undoes
    ``encode`` column by column in reverse order."""

    def __init__(self, columns: dict[str, tuple[str, bool]], strict: bool = True):
        self.columns = columns
        self.strict = strict

    def encode(self, df: DataFrame) -> DataFrame:
        for c, (prefix, is_array) in self.columns.items():
            fn = parse_id_array if is_array else parse_id
            df = df.withColumn(c, fn(F.col(c), prefix, self.strict))
        return df

    def decode(self, df: DataFrame) -> DataFrame:
        for c, (prefix, is_array) in reversed(list(self.columns.items())):
            if c in df.columns:
                fn = build_id_array if is_array else build_id
                df = df.withColumn(c, fn(F.col(c), prefix))
        return df


# The source system's id prefixes.
DEFAULT_CODEC = IdCodec({"user_id": ("u_", False), "vacancy_id": ("v_", True)})


def rename_reversible(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Drop the target names first, then rename."""
    return df.drop(*[v for v in mapping.values() if v in df.columns]).withColumnsRenamed(mapping)


def rename_back(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    inverse = {v: k for k, v in mapping.items() if v in df.columns}
    return df.drop(*[k for k in inverse.values() if k in df.columns]).withColumnsRenamed(inverse)
