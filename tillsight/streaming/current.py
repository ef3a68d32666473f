"""The current rows of a windowed stream result, as a table that is rewritten only where it changes.

Rows lie in folders by the period of their window.  A manifest names, for each period, the folder that
holds its rows and their number.  A micro-batch writes the periods it touches to new folders, and one
rename of a new manifest makes them valid: until then, and if the batch dies, the old state is read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from .sinks import start

#: Manifests that are kept; folders that none of them names are deleted.
KEPT = 3
#: Newest periods that count as open; an older one is rewritten as a single file.
OPEN = 2
_PERIOD = "_period"


class CurrentTable:
    """Current rows by ``keys`` under ``path``; ``period`` is the pattern that makes a period of ``window_start``."""

    def __init__(
        self, spark: SparkSession, path: str, schema, keys: Sequence[str], period: str = "yyyy-MM-dd", window: str = "window_start"
    ) -> None:
        self.spark, self.path, self.schema, self.keys = spark, path.rstrip("/"), schema, list(keys)
        #: Called with the number of a batch when its rows are written and not yet valid.
        self.before_commit: Callable[[int], None] | None = None
        self.period = F.coalesce(F.date_format(window, period), F.lit("none"))
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._text = jvm.org.apache.commons.io.IOUtils

    def _manifests(self) -> list[str]:
        """Names of all manifests, oldest first."""
        folder = self._path(f"{self.path}/manifests")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(n for n in names if n.endswith(".json"))

    def _load(self, name: str) -> dict:
        stream = self._fs.open(self._path(f"{self.path}/manifests/{name}"))
        try:
            return json.loads(self._text.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def manifest(self) -> dict:
        """``batch``: the last one that is part of the state; ``periods``: period to ``[folder, rows, closed]``."""
        names = self._manifests()
        return self._load(names[-1]) if names else {"batch": -1, "periods": {}}

    def _commit(self, manifest: dict) -> None:
        name = f"{manifest['batch']:020d}.json"
        draft = self._path(f"{self.path}/manifests/.{uuid.uuid4().hex}")
        out = self._fs.create(draft)
        try:
            out.write(json.dumps(manifest, sort_keys=True).encode())
        finally:
            out.close()
        if not self._fs.rename(draft, self._path(f"{self.path}/manifests/{name}")):
            raise OSError(f"manifest {name} could not be put in place")

    def _drop_unnamed(self) -> None:
        """Delete what the kept manifests do not name, and older manifests."""
        names = self._manifests()
        kept = {folder for n in names[-KEPT:] for folder, _, _ in self._load(n)["periods"].values()}
        for n in names[:-KEPT]:
            for folder, _, _ in self._load(n)["periods"].values():
                if folder not in kept:
                    self._fs.delete(self._path(f"{self.path}/{folder}"), True)
            self._fs.delete(self._path(f"{self.path}/manifests/{n}"), False)

    def _read(self, folders: Sequence[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{f}" for f in folders])

    def _write(self, rows: DataFrame, batch: int, closed: bool) -> dict:
        """Write rows to new folders by period; the entries that the manifest will have for them."""
        folder = f"rows/{batch:020d}-{uuid.uuid4().hex}"
        dealt = rows.withColumn(_PERIOD, self.period)
        if closed:
            dealt = dealt.repartition(_PERIOD)
        dealt.write.partitionBy(_PERIOD).parquet(f"{self.path}/{folder}")
        counts = self.spark.read.schema(f"{_PERIOD} STRING").parquet(f"{self.path}/{folder}").groupBy(_PERIOD).count().collect()
        return {r[0]: [f"{folder}/{_PERIOD}={r[0]}", r[1], closed] for r in counts}

    def merge(self, changed: DataFrame, batch: int) -> None:
        """Put the changed rows of a batch in place of those with the same keys; one that is in the state already is left out."""
        before = self.manifest()
        if batch <= before["batch"]:
            return
        changed = changed.persist()
        try:
            touched = [r[0] for r in changed.select(self.period).distinct().collect()]
            old = [before["periods"][p][0] for p in touched if p in before["periods"]]
            same = [F.col(f"n.{k}").eqNullSafe(F.col(f"o.{k}")) for k in self.keys]
            kept = self._read(old).alias("o").join(changed.select(*self.keys).alias("n"), same, "left_anti")
            periods = before["periods"] | (self._write(kept.unionByName(changed), batch, False) if touched else {})
        finally:
            changed.unpersist()
        newest = sorted(periods, reverse=True)
        done = [p for p in newest[OPEN:] if not periods[p][2]]
        if done:
            periods |= self._write(self._read([periods[p][0] for p in done]), batch, True)
        if self.before_commit:
            self.before_commit(batch)
        self._commit({"batch": batch, "periods": periods})
        self._drop_unnamed()

    def read(self, at_least: int | None = None) -> DataFrame:
        """The current rows; or those of the newest periods only, as many as it takes to have so many rows."""
        periods = self.manifest()["periods"]
        folders, rows = [], 0
        for p in sorted(periods, reverse=True):
            if at_least is not None and rows >= at_least:
                break
            folders.append(periods[p][0])
            rows += periods[p][1]
        return self._read(folders)


def to_current(df: DataFrame, table: CurrentTable, checkpoint: str, every: str | None = None, name: str | None = None) -> StreamingQuery:
    """Keep a table at the current rows of an update-mode result; a batch that runs again changes nothing twice."""
    writer = df.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(table.merge)
    return start(writer.queryName(name) if name else writer, every)
