"""Where stream results go, and how their current state is read back."""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener


def start(writer: DataStreamWriter, every: str | None) -> StreamingQuery:
    """Start as the session is set; the number of state partitions is fixed at the first start."""
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return writer.start()


def to_memory(df: DataFrame, name: str, checkpoint: str | None, mode: str = "update", every: str | None = None) -> StreamingQuery:
    """In-memory table on the driver, for small results under inspection.

    In update mode it holds every version of a changed row; see :func:`latest_version`.
    """
    writer = df.writeStream.format("memory").queryName(name).outputMode(mode)
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    return start(writer, every)


def to_parquet(
    df: DataFrame, path: str, checkpoint: str, every: str | None = None, name: str | None = None
) -> StreamingQuery:
    """Append finished rows to a Parquet folder, each exactly once."""
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return start(writer.queryName(name).option("path", path) if name else writer.option("path", path), every)


def to_versions(df: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Write the changed rows of each micro-batch as versions numbered by the batch.

    A batch that runs again after a failure overwrites its own folder, so every version is
    there once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = df.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write)
    return start(writer, every)


def latest_version(versions: DataFrame, keys: Sequence[str], version: str = "batch_id") -> DataFrame:
    """The newest version of each row, by aggregation."""
    values = [c for c in versions.columns if c not in keys and c != version]
    newest = F.max_by(F.struct(*values), F.col(version)).alias("_newest")
    return versions.groupBy(*keys).agg(newest).select(*keys, "_newest.*")


def read_versions(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """All versions written under ``path``."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in like.schema.fields)
    return spark.read.schema(columns + ", batch_id BIGINT").parquet(path)


def fan_out(
    df: DataFrame, outputs: dict[str, Callable[[DataFrame], DataFrame]], path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Several stateless results from one read of the source.

    Each micro-batch is kept while its outputs are written; every output has a folder per
    batch, which a repeated batch overwrites.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            for name, job in outputs.items():
                job(kept).write.mode("overwrite").parquet(f"{path}/{name}/batch_id={batch_id}")
        finally:
            kept.unpersist()

    writer = df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return start(writer, every)


class Progress(StreamingQueryListener):
    """Rows read and micro-batches run by each named query, as the session reports them."""

    def __init__(self) -> None:
        self.rows: dict[str, int] = {}
        self.batches: dict[str, int] = {}
        self._names: dict[str, str] = {}
        self._ended: set[str] = set()
        self._change = threading.Condition()

    def onQueryStarted(self, event) -> None:
        self._names[str(event.id)] = event.name

    def onQueryProgress(self, event) -> None:
        name = event.progress.name
        self.rows[name] = self.rows.get(name, 0) + event.progress.numInputRows
        self.batches[name] = self.batches.get(name, 0) + 1

    def onQueryTerminated(self, event) -> None:
        with self._change:
            self._ended.add(self._names.get(str(event.id), str(event.id)))
            self._change.notify_all()

    def wait_for(self, names: Sequence[str], seconds: float = 60) -> None:
        """Until the end of all these queries was reported."""
        with self._change:
            if not self._change.wait_for(lambda: set(names) <= self._ended, seconds):
                raise TimeoutError(f"no report of the end of {sorted(set(names) - self._ended)}")


def run_together(spark: SparkSession, starts: dict[str, Callable[[], StreamingQuery]]) -> Progress:
    """Run several queries at once, each in a scheduler pool of its own, until all have ended.

    ``starts`` starts a query of the name that stands before it.  An error of one stops the others and is raised.
    """
    progress, running = Progress(), []
    spark.streams.addListener(progress)
    try:
        for name, begin in starts.items():
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
            running.append(begin())
        finish(*running)
        progress.wait_for(list(starts))
    finally:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)
        for q in running:
            if q.isActive:
                q.stop()
        spark.streams.removeListener(progress)
    return progress


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def state_provider(spark: SparkSession, provider: str = ROCKSDB) -> Iterator[None]:
    """Queries that start inside keep their state with this provider; a checkpoint remembers it."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, provider)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def finish(*queries: StreamingQuery) -> None:
    """Wait for queries that process what is available and then end; an error is raised here."""
    for q in queries:
        q.awaitTermination()
