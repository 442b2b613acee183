"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_SCOPE: ContextVar[str | None] = ContextVar("scope", default=None)


def shared_folder(spark: SparkSession) -> str:
    """A new folder name below ``spark.checkpoint.dir``, or else the context's checkpoint folder.

    Only a local session without either sets one of its own, which is removed when the program
    ends: on a cluster such a folder would be on one machine only.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        own = tempfile.TemporaryDirectory(prefix="tallymark-", ignore_cleanup_errors=True)
        atexit.register(own.cleanup)
        spark.sparkContext.setCheckpointDir(own.name)
        root = spark.sparkContext.getCheckpointDir()
    return f"{(_SCOPE.get() or root).rstrip('/')}/tallymark-{uuid.uuid4().hex}"


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder in any file system that Spark writes to."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Folders and tables that are made within go when it ends, as those of a micro-batch that is done."""
    folder = shared_folder(spark)
    token = _SCOPE.set(folder)
    try:
        yield folder
    finally:
        _SCOPE.reset(token)
        remove(spark, folder)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    What follows no longer depends on the lineage, survives lost executors, and starts from a
    table whose size Spark knows. The folder is left for the cluster's own clean-up, unless it is made
    within :func:`scratch`.
    """
    spark = df.sparkSession
    path = shared_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
