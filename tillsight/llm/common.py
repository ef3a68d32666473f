"""Helpers that several operators share: folds, group streams, tiles of large groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..sources.shared import materialize

#: Words of a text: runs of anything but the six ASCII space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_fold(id_col: str, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves the remainder; a NULL id counts as in the fold."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus == remainder, F.lit(True))


def word_count(text: str) -> Column:
    """Number of words; 0 for NULL."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def sampled(rows: DataFrame, group: str, id_col: str, most: int, seed: int) -> DataFrame:
    """The ``most`` ids of every group with the smallest hashes, or all ids of a smaller group, each once.

    Ids are counted first, and only those with a hash small enough for about half as many again are ranked: what
    meets in a group's task depends on ``most`` alone, not on the rows or on the number of tasks before it.
    """
    draw = F.xxhash64(F.lit(seed), F.col(id_col))
    sizes = materialize(rows.groupBy(F.col(group).alias("_of")).agg(F.approx_count_distinct(id_col).alias("_n")))
    share = F.lit(1.5 * most + 50.0) / F.col("_n")
    low = rows.join(sizes, F.col(group) == F.col("_of")).where(draw.cast("double") / F.lit(2.0**64) + 0.5 <= share)
    order = Window.partitionBy(group).orderBy(draw, id_col)
    return (
        low.select(group, id_col)
        .distinct()
        .withColumn("_row", F.row_number().over(order))
        .where(F.col("_row") <= most)
        .drop("_row")
    )


def portions(batch: pa.RecordBatch, text: str = "text", most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts take about so many bytes; a longer text stands alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    first = 0
    while first < len(ends):
        before = int(ends[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(first, last - first)
        first = last


def groups_of(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The runs of equal keys in a partition that is sorted by them, one table each."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_pylist() for k in keys]
        rows = list(zip(*columns))
        cuts = [0, *[i for i in range(1, len(rows)) if rows[i] != rows[i - 1]], len(rows)]
        for a, b in zip(cuts, cuts[1:]):
            if held and rows[a] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = rows[a]
    if held:
        yield pa.Table.from_batches(held)


def tiled(rows: DataFrame, keys: list[str], id_col: str, size: int) -> DataFrame:
    """Deal every group of equal keys over tasks, so that any two of its rows meet once or more.

    A group of n rows is cut by a hash of the id into ceil(n / size) parts, and every pair of
    parts, also of a part with itself, is a tile: no task holds more than about two parts.  Adds ``_part``
    and the tile ``(_lo, _hi)``.  Groups of one row are left out, as they have no pairs.
    """
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    parts = F.ceil(F.col("_n") / F.lit(size)).cast("int")
    dealt = rows.join(counted, keys).withColumn("_part", F.pmod(F.xxhash64(id_col), parts).cast("int"))
    other = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), parts - 1)))
    return (
        other.withColumns({"_lo": F.least("_part", "_other"), "_hi": F.greatest("_part", "_other")})
        .drop("_n", "_other")
        .repartition(*keys, "_lo", "_hi")
        .sortWithinPartitions(*keys, "_lo", "_hi", "_part", id_col)
    )


class Memory:
    """Values by key in two generations: what is used again outlives the older one, which is dropped."""

    def __init__(self, most: int) -> None:
        self.most, self.young, self.old = most, {}, {}

    def get(self, key):
        """The value, or None if it is not known."""
        value = self.young.get(key)
        if value is None and (value := self.old.get(key)) is not None:
            self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(self.young) >= self.most:
            self.old, self.young = self.young, {}
        self.young[key] = value


class Forest:
    """Union-find over hashable ids, which tells whether a link joins two trees."""

    def __init__(self) -> None:
        self.parent: dict = {}

    def root(self, x):
        parent = self.parent
        top = x
        while (up := parent.get(top, top)) != top:
            top = up
        while x != top:
            parent[x], x = top, parent.get(x, x)
        return top

    def join(self, a, b) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True
