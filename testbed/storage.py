"""Storage for runs inside one process, where the session names none."""

from __future__ import annotations

import functools
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def with_storage(spark: SparkSession) -> SparkSession:
    """Names a temporary checkpoint folder for a ``local[...]`` session that has none.

    A cluster's session is left as it is: there the folder must be shared, and
    the library raises when it is missing.
    """
    context = spark.sparkContext
    if spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir():
        return spark
    if context.master == "local" or context.master.startswith("local["):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="loanlens-"))
    return spark


def stored_locally(query: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The query, run on a session that has storage."""

    @functools.wraps(query)
    def run(spark: SparkSession, *rest) -> DataFrame:
        return query(with_storage(spark), *rest)

    return run
