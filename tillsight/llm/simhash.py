"""SimHash near-dedup: fingerprints of word shingles, linked with BK-trees.

Fingerprints within the radius agree on some blocks of their bits, so they are dealt to shards by
the bits of those blocks.  In a shard a BK-tree is built of one part of its fingerprints, with children keyed by
their Hamming distance to the parent, and every fingerprint of the shard is looked up in it along the edges
within the radius only.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.shared import materialize
from .common import Forest, groups_of, table, tiled
from .components import components

RADIUS = 3
SHINGLE = 3
SEED = 42
#: Blocks of the 64 bits.  Fingerprints within 3 bits agree on 2 of 5 blocks at least.
BLOCKS = (13, 13, 13, 13, 12)
#: Fingerprints of a shard that make one tree.
TREE = 2_048

_h = xxhash.xxh64_intdigest


def fingerprint(text: str | None) -> int:
    """Unsigned fingerprint of a whole text; 0 without words or for NULL."""
    words = (text or "").encode().lower().split()  # of bytes: only A-Z, only the six ASCII space characters
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= SHINGLE:
        hashes = [_h(joined, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        last = SHINGLE - 1
        hashes = [_h(joined[a:b], SEED) for a, b in zip(starts[:-last].tolist(), ends[last:].tolist())]
    rows = np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(rows), 1 << 14):
        ones += np.unpackbits(rows[i : i + (1 << 14)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(rows)).tobytes(), "big")


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = np.array([fingerprint(t.as_py()) for t in batch.column("text")], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(made, pa.int64())], ["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fp``: the fingerprint as a signed number of 64 bits."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _fingerprint_batches, "doc_id bigint, fp bigint"
    )


class BKTree:
    """Integers with the Hamming metric; nodes and children in flat lists."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        n = len(self.values)
        self.values.append(value)
        self.children.append({})
        if not n:
            return
        at = 0
        while True:
            d = (self.values[at] ^ value).bit_count()
            down = self.children[at].get(d)
            if down is None:
                self.children[at][d] = n
                return
            at = down

    def within(self, value: int, radius: int) -> list[int]:
        """Positions, in order of insertion, of the values within the radius."""
        found, todo = [], [0] if self.values else []
        while todo:
            at = todo.pop()
            d = (self.values[at] ^ value).bit_count()
            if d <= radius:
                found.append(at)
            for edge, child in self.children[at].items():
                if -radius <= edge - d <= radius:
                    todo.append(child)
        return found


def _link_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A spanning forest of the links of each tile: no more links than rows."""
    mask = (1 << 64) - 1
    keys = ["shard", "bits", "_lo", "_hi"]
    out_a, out_b = [], []

    def ready() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], ["a", "b"])
        out_a.clear()
        out_b.clear()
        return made

    for tile in groups_of(batches, keys):
        lo, hi = tile.column("_lo")[0].as_py(), tile.column("_hi")[0].as_py()
        part, reps = tile.column("_part").to_pylist(), tile.column("rep").to_pylist()
        fps = [x & mask for x in tile.column("fp").to_pylist()]
        tree, members, forest = BKTree(), [], Forest()
        for rep, fp, p in zip(reps, fps, part):  # sorted by part: the tree's part comes first
            if p == hi:
                for at in tree.within(fp, RADIUS):
                    if forest.join(rep, members[at]):
                        out_a.append(rep)
                        out_b.append(members[at])
            if p == lo:
                tree.add(fp)
                members.append(rep)
        if len(out_a) > 50_000:
            yield ready()
    yield ready()


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def shard_masks() -> list[int]:
    """Masks of the bits that name a shard: for every choice of the blocks that must agree."""
    masks, at = [], 0
    for width in BLOCKS:
        masks.append(((1 << width) - 1) << at)
        at += width
    return [sum(c) for c in combinations(masks, len(BLOCKS) - RADIUS)]


def links(classes: DataFrame) -> DataFrame:
    """Links ``a, b`` that join all ``(rep, fp)`` within the radius, with distinct fingerprints.

    A shard's tree goes to the tasks that look into it through the shuffle: trees of all fingerprints grow
    with the data, so they may not be broadcast variables.  A shard that holds very many fingerprints is
    cut into trees of a bounded size, and each is met by each part of the shard.
    """
    shards = F.array(
        *[
            F.struct(F.lit(i).alias("shard"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("bits"))
            for i, m in enumerate(shard_masks())
        ]
    )
    dealt = classes.select("rep", "fp", F.inline(shards))
    return tiled(dealt, ["shard", "bits"], "rep", TREE).select(
        "shard", "bits", "_lo", "_hi", "_part", "rep", "fp"
    ).mapInArrow(_link_batches, "a bigint, b bigint")


def grouped(docs: DataFrame) -> DataFrame:
    """``doc_id, fp, group, component`` of every row; the group is the smallest fingerprint that links lead to.

    Documents with one fingerprint are one class, which enters the search once however large it is; classes and
    groups are joined back by equi joins.  Classes are named by their fingerprints, so those of one doc_id with
    several texts stay apart, and a row with a NULL doc_id links others like any row.  ``component`` is the
    smallest doc_id of the group, NULL if it has none.  NULL and empty texts have fingerprint 0.
    """
    made = materialize(fingerprints(docs))
    classes = materialize(made.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    linked = materialize(components(links(classes.select(F.col("fp").alias("rep"), "fp"))))
    named = materialize(
        classes.join(linked, F.col("fp") == F.col("node"), "left").select(
            F.col("fp").alias("_fp"), F.coalesce("component", "fp").alias("group"), "rep"
        )
    )
    least = named.groupBy(F.col("group").alias("_group")).agg(F.min("rep").alias("component"))
    known = named.join(least, F.col("group") == F.col("_group")).select("_fp", "group", "component")
    return made.join(known, F.col("fp") == F.col("_fp")).select("doc_id", "fp", "group", "component")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, fp, component`` of every row: the smallest doc_id that links lead to, its own included."""
    return grouped(docs).select("doc_id", "fp", "component")


def _with_fingerprint(text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array([fingerprint(t.as_py()) for t in batch.column(text)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.int64())], [*batch.schema.names, "fp"])

    return run


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents without near copies: of each group the row that is first by doc_id and text, NULL ids last.

    A doc_id that stands on one row names it; only rows of other doc_ids and of none get
    their fingerprint again, which tells to which group each belongs.
    """
    found = materialize(grouped(docs))
    is_first = F.col("doc_id") == F.col("component")
    firsts = (
        found.groupBy(F.col("doc_id").alias("_kept"))
        .agg(F.count(F.lit(1)).alias("_n"), F.max(is_first).alias("_first"))
        .where("_first")
    )
    repeated = materialize(firsts.where("_n > 1").select("_kept"))  # of a size that Spark knows: mostly empty
    names = docs.columns
    aside = docs.toDF(*[f"d{i}" for i in range(len(names))])  # a column of any name passes through
    doc_id, text = (F.col(f"d{names.index(n)}") for n in ("doc_id", "text"))
    single = aside.join(firsts.where("_n = 1"), doc_id.cast("long") == F.col("_kept")).select(*aside.columns)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in aside.schema)
    again = (
        aside.join(repeated, doc_id.cast("long") == F.col("_kept"))
        .select(*aside.columns)
        .unionByName(aside.where(doc_id.isNull()))
        .mapInArrow(_with_fingerprint(f"d{names.index('text')}"), f"{kinds}, fp bigint")
    )
    wanted = found.where(is_first | F.col("component").isNull()).select(F.col("doc_id").alias("_kept"), F.col("fp").alias("_fp"), "group").distinct()
    several = (
        again.join(wanted, doc_id.cast("long").eqNullSafe(F.col("_kept")) & (F.col("fp") == F.col("_fp")))
        .groupBy("group")
        .agg(F.min_by(F.struct(*aside.columns), F.struct(text)).alias("_row"))
        .select("_row.*")
    )
    return single.unionByName(several).toDF(*names)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every row of ``documents``, see :func:`grouped`."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id")
    )
