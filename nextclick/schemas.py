"""Table shapes used across the package and the split enum."""

from __future__ import annotations

from enum import Enum

from pyspark.sql import types as T

SESSION_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("vacancy_id", T.ArrayType(T.LongType())),
    T.StructField("action_type", T.ArrayType(T.IntegerType())),
    T.StructField("action_dt", T.ArrayType(T.TimestampNTZType())),
])

SUBMISSION_SCHEMA = "user_id long, session_id string, predictions array<long>"

# Action codes: 1 is a response (the target event); 2 and 3 only carry weights.
RESPONSE = 1


class Split(Enum):
    VALIDATION = "val"
    TEST = "test"
    MICRO = "micro"

    @property
    def folder(self) -> str:
        return {"val": "validation", "test": "submit", "micro": "micro"}[self.value]
