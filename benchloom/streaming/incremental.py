"""Incremental jobs as streams: new files in, new rows out, progress in the checkpoint.

The file source remembers which files it has read and the checkpoint which
micro-batch was written, so a stopped job goes on where it ended.  Operators are the
batch ones.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.collect import pending
from ..sources.files import is_report, report_names


def state_folder(spark: SparkSession, job: str, default: str | None = None) -> str:
    """Where a stream keeps its progress: below the shared folder that the cluster names.

    ``default`` is used only on a session that names none.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or default
    if not root:
        raise ValueError("the session sets no spark.checkpoint.dir and no default was given")
    return f"{root.rstrip('/')}/{job}"


def stream_jsonl(spark: SparkSession, path: str, schema: str, files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(path)


def stream_reports(
    spark: SparkSession, root: str, language: str, files_per_batch: int = 10000
) -> DataFrame:
    """``path, text`` of the report files that appear below a folder."""
    files = (
        spark.readStream.option("recursiveFileLookup", True)
        .option("wholetext", True)
        .option("pathGlobFilter", report_names(language))
        .option("maxFilesPerTrigger", files_per_batch)
        .text(root)
    )
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")).where(
        is_report(F.col("path"), language)
    )


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def process_new(
    source: DataFrame,
    operator: Callable[[DataFrame], DataFrame],
    sink: str,
    checkpoint: str,
    keys: Sequence[str] = (),
    done: DataFrame | None = None,
) -> StreamingQuery:
    """Run a batch operator over whatever is new, then stop.

    A micro-batch replaces its own output folder, so one that is repeated after a
    failure writes its rows once.  With ``keys`` an item is taken once: the keys seen so far are the state of the
    stream, kept by RocksDB below the checkpoint, so a batch looks up its own keys and never reads the sink.
    ``done`` holds keys that something else has processed before.
    """

    def write(batch: DataFrame, number: int) -> None:
        rows = batch if done is None else pending(batch, done, list(keys))
        operator(rows).write.mode("overwrite").parquet(f"{sink}/batch={number}")

    session = source.sparkSession
    rows = source.dropDuplicates(list(keys)) if keys else source
    before = session.conf.get(PROVIDER, None)
    session.conf.set(PROVIDER, ROCKSDB)
    try:
        return (
            rows.writeStream.foreachBatch(write)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        session.conf.unset(PROVIDER) if before is None else session.conf.set(PROVIDER, before)
