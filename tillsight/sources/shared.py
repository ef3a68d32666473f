"""The folder that every executor can reach, and intermediate tables kept in it."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def session_folder(spark: SparkSession) -> str:
    """The one folder that holds the intermediate tables of this session.

    It lies in ``spark.checkpoint.dir``, or in the warehouse folder where that is unset.  Unless the session is local,
    a warehouse on a machine's own disk is refused: executors elsewhere would not see it.  The name holds the
    application's id, so that sessions do not meet and a later one can find and drop what an earlier one left.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir")
        if _on_this_machine(spark, root) and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    return f"{root.rstrip('/')}/tillsight-{spark.sparkContext.applicationId}"


def _on_this_machine(spark: SparkSession, path: str) -> bool:
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getUri().getScheme() == "file"


def shared_folder(spark: SparkSession) -> str:
    """A new path in the folder of the session."""
    return f"{session_folder(spark)}/{uuid.uuid4().hex}"


def drop_session_folder(spark: SparkSession) -> bool:
    """Delete the intermediate tables of this session; frames that read them end with it."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(session_folder(spark))
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def _set(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Settings of the session for what runs inside."""
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _shuffling_to(spark: SparkSession, tasks: int) -> dict[str, str]:
    """Shuffles go to so many tasks; skewed joins are still split."""
    most = max(tasks, spark.sparkContext.defaultParallelism)
    return {"spark.sql.shuffle.partitions": str(most), "spark.sql.adaptive.coalescePartitions.enabled": "false"}


def _measured_broadcasts(spark: SparkSession) -> dict[str, str]:
    """Joins broadcast a side by the size that its shuffle has, not by that of its files."""
    at_run_time, by_files = "spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.autoBroadcastJoinThreshold"
    return {at_run_time: spark.conf.get(at_run_time, None) or spark.conf.get(by_files), by_files: "-1"}


def materialize(df: DataFrame, tasks: int | None = None, measured: bool = False) -> DataFrame:
    """Write a frame that several later passes read, and return it as a table scan.

    The lineage ends at the written files, so a lost executor costs a re-read and not a
    re-computation; later passes get column pruning and true sizes for broadcast decisions.
    With ``tasks``, its shuffles go to at least so many tasks and one for each core, whatever
    the session's number of partitions.  With ``measured``, its joins broadcast nothing that only its
    compressed files let seem small: the driver holds a broadcast table with all its rows.
    """
    spark = df.sparkSession
    path = shared_folder(spark)
    wanted = ({} if tasks is None else _shuffling_to(spark, tasks)) | (_measured_broadcasts(spark) if measured else {})
    with _set(spark, wanted):
        df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored._stored_in = path
    return stored


def drop_stored(*frames: DataFrame) -> None:
    """Delete the files of frames that :func:`materialize` made and that nothing reads any more."""
    for df in frames:
        path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(df._stored_in)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
