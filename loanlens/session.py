"""Session settings the jobs rely on, and the shared folder for written results."""

from __future__ import annotations

import contextlib
import contextvars
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Runtime settings worth having on a cluster; all can be set on a running session.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # what a Python task holds at a time, on both sides
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


_RUN: contextvars.ContextVar[str | None] = contextvars.ContextVar("run_folder", default=None)


def use_recommended(spark: SparkSession) -> SparkSession:
    for key, value in RECOMMENDED.items():
        spark.conf.set(key, value)
    return spark


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written once to the shared folder and read back.

    For results several plans read: nothing is computed twice, and a lost
    executor costs a re-read instead of a recomputation.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_folder(spark: SparkSession) -> str:
    """A new folder under the cluster's ``spark.checkpoint.dir``.

    Where that is unset, the folder given to ``setCheckpointDir`` is used; with
    neither there is no place all executors share, and this raises.  Inside
    ``run_folder`` the new folder lies in that of the run.
    """
    root = _RUN.get() or spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{root.rstrip('/')}/loanlens-{uuid.uuid4().hex}"


@contextlib.contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """What is stored in this block goes into one folder, which is removed at its end, also after a failure.

    Write the results, or collect them, inside: frames that read stored rows
    cannot be used afterwards.  Runs may stand in each other; threads started
    inside do not belong to the run.
    """
    folder = shared_folder(spark)
    token = _RUN.set(folder)
    try:
        yield folder
    finally:
        _RUN.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
