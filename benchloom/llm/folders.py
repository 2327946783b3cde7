"""Where intermediate tables go: below the folder that the cluster shares."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Whether Spark deletes the shuffles of a query when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``.

    Only a session on one machine that names none, as in tests, gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("the session of a cluster has to name a shared folder in spark.checkpoint.dir")
        base = f"file://{tempfile.mkdtemp(prefix='benchloom-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The rows, written once and read again, and the folder they are in.

    What was shuffled on the way is deleted when the rows are written, not some time after, when the driver collects garbage.
    """
    spark = df.sparkSession
    folder = shared_folder(spark, name)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(folder)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(folder), folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once and read again: later steps neither recompute nor lose them."""
    return store(df, name)[0]


def discard(spark: SparkSession, folder: str) -> None:
    """Delete a folder that :func:`store` has made, when no plan reads it any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
