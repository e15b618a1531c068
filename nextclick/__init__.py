"""nextclick: session-based next-response recommendation on Spark.

Every operator is a function ``DataFrame (+ params) -> DataFrame`` with a
declared total order, so results repeat at any cluster size and can be
checked against plain SQL. Compose them with ``DataFrame.transform``.
"""

from nextclick.session import get_spark, checkpoint_dir  # noqa: F401
