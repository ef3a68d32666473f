"""Embedding near-dedup by a subspace pigeonhole join.

Unit vectors with cosine c are sqrt(2 - 2c) apart, and a rotation changes no distance.  Cut into
blocks of dimensions, two such vectors are, in one block at least, within that block's
proportional share of the squared distance.  Each block is joined by range: its first coordinates
make a grid, a vector stands in its own cell and asks in every cell that its reach touches.  Cells
get the block's coordinates only; whole vectors follow to those cells where they are near another.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..sources.shared import materialize
from .common import Forest, groups_of, table, tiled
from .components import components
from .vectors import usable

COSINE = 0.98
#: Blocks of the rotated vector, and coordinates of a block that make the grid.
BLOCKS, GRID = 8, 2
#: Vectors of a cell that are compared at once.
TILE = 4_096
SEED = 20_240_607
#: Allowance for rounding in single precision; only the exact check decides.
_SLACK = 1e-4


def rotation(dims: int) -> np.ndarray:
    """A seeded random rotation."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dims, dims)))
    return (q * np.sign(np.diag(r))).astype(np.float64)


def rotated(vectors: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """Unit vectors after rotation, in single precision.

    Summed dimension by dimension: a row's result does not depend on the rows beside it, so that every
    task has the same coordinates of a vector.
    """
    x = vectors.astype(np.float64)
    scale = np.zeros(len(x))
    for d in range(x.shape[1]):
        scale += x[:, d] * x[:, d]
    x /= np.sqrt(scale)[:, None]
    out = np.zeros_like(x)
    for d in range(x.shape[1]):
        out += x[:, d : d + 1] * turn[d]
    return out.astype(np.float32)


def _blocks(dims: int) -> list[slice]:
    n = min(BLOCKS, dims)
    edges = [dims * i // n for i in range(n + 1)]
    return [slice(a, b) for a, b in zip(edges, edges[1:])]


def _budget(block: slice, dims: int) -> float:
    return (2 - 2 * COSINE) * (block.stop - block.start) / dims * (1 + _SLACK) + 1e-7


def _matrix(column, dims: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(flat.flatten(), np.float32).reshape(-1, dims)


def _cell_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for every block and every cell that a vector's reach touches; ``home`` marks its own."""
    turns: dict[int, np.ndarray] = {}
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = np.array([len(v) for v in batch.column("embedding")])
        for dims in np.unique(lengths).tolist():
            rows = np.nonzero(lengths == dims)[0]
            part = batch.take(pa.array(rows))
            at = rotated(_matrix(part.column("embedding"), dims), turns.setdefault(dims, rotation(dims)))
            for b, block in enumerate(_blocks(dims)):
                reach = np.sqrt(_budget(block, dims))
                axes = range(block.start, min(block.start + GRID, block.stop))
                low = [np.floor((at[:, d] - reach) / (2 * reach)).astype(np.int64) for d in axes]
                high = [np.floor((at[:, d] + reach) / (2 * reach)).astype(np.int64) for d in axes]
                home = [np.floor(at[:, d] / (2 * reach)).astype(np.int64) for d in axes]
                for step in np.ndindex(*(2,) * len(low)):  # a reach of half a cell's side touches two cells an axis
                    touched = np.ones(len(part), bool)
                    own = np.ones(len(part), bool)
                    cell = np.zeros(len(part), np.int64)
                    for s, lo, hi, h in zip(step, low, high, home):
                        touched &= lo + s <= hi
                        own &= lo + s == h
                        cell = cell * 65_536 + (lo + s) + 32_768
                    some = np.nonzero(touched)[0]
                    if not len(some):
                        continue
                    got = part.take(pa.array(some))
                    n = len(some)
                    yield pa.RecordBatch.from_arrays(
                        [
                            got.column("label"),
                            pa.array(np.full(n, dims), pa.int32()),
                            pa.array(np.full(n, b), pa.int32()),
                            pa.array(cell[some], pa.int64()),
                            pa.array(own[some]),
                            got.column("rep"),
                            pa.FixedSizeListArray.from_arrays(
                                pa.array(at[some, block].ravel()), block.stop - block.start
                            ).cast(pa.list_(pa.float32())),
                        ],
                        ["label", "dims", "block", "cell", "home", "rep", "at"],
                    )


def _near(a: np.ndarray, b: np.ndarray, budget: float) -> np.ndarray:
    """Which pairs of rows of a block's coordinates are within its budget; elementwise, so that every task agrees."""
    total = np.zeros((len(a), len(b)), np.float32)
    for d in range(a.shape[1]):
        gap = a[:, d : d + 1] - b[None, :, d]
        total += gap * gap
    return total <= np.float32(budget)


def _within(a: np.ndarray, b: np.ndarray, budget: float) -> np.ndarray:
    """Which rows of a are within the budget of the row of b beside them, by the sums of :func:`_near`."""
    total = np.zeros(len(a), np.float32)
    for d in range(a.shape[1]):
        gap = a[:, d] - b[:, d]
        total += gap * gap
    return total <= np.float32(budget)


def _near_pairs(at: np.ndarray, rep: np.ndarray, ask: np.ndarray, stand: np.ndarray, budget: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of an asking and a standing row of a block within its budget, the asking one of the larger ``rep``.

    Both sides go by the block's last coordinate, and only rows within reach on it are compared.
    """
    ask, stand = (rows[np.argsort(at[rows, -1], kind="stable")] for rows in (ask, stand))
    along, reach = at[stand, -1], np.float32(np.sqrt(budget) * (1 + _SLACK))
    for i in range(0, len(ask), 128):
        rows = ask[i : i + 128]
        first = np.searchsorted(along, at[rows[0], -1] - reach, side="left")
        last = np.searchsorted(along, at[rows[-1], -1] + reach, side="right")
        if first < last:
            near = stand[first:last]
            left, right = np.nonzero((rep[rows][:, None] > rep[near][None]) & _near(at[rows], at[near], budget))
            if len(left):
                yield rows[left], near[right]


def _sides(tile: pa.Table) -> list[tuple[np.ndarray, np.ndarray]]:
    """The rows that ask and those that stand in the cell, for either order of the tile's two parts."""
    lo, hi = (tile.column(c)[0].as_py() for c in ("_lo", "_hi"))
    part, home = np.asarray(tile.column("_part")), np.asarray(tile.column("home"))
    orders = [(lo, hi)] if lo == hi else [(lo, hi), (hi, lo)]
    return [(np.nonzero(part == a)[0], np.nonzero((part == b) & home)[0]) for a, b in orders]


_TILE = ["label", "dims", "block", "cell", "_lo", "_hi"]


def _hopeful_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each tile the rows that are near another one in the tile's block."""
    for tile in groups_of(batches, _TILE):
        dims, b = tile.column("dims")[0].as_py(), tile.column("block")[0].as_py()
        block = _blocks(dims)[b]
        at, rep = _matrix(tile.column("at"), block.stop - block.start), np.asarray(tile.column("rep"))
        hopeful = np.zeros(len(rep), bool)
        for ask, stand in _sides(tile):
            for x, y in _near_pairs(at, rep, ask, stand, _budget(block, dims)):
                hopeful[x] = hopeful[y] = True
        if hopeful.any():
            yield from tile.select([*_TILE, "_part", "home", "rep"]).filter(pa.array(hopeful)).to_batches()


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of paired rows in double precision."""
    a, b = a.astype(np.float64), b.astype(np.float64)
    dot = np.einsum("ij,ij->i", a, b)
    return dot / (np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b)))


def _tile_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each tile the links' counts per vector (``b`` NULL) and a spanning forest of the links (``n`` 0).

    A pair is taken up by the vector with the larger id, asking in the home cell of the other, and
    counted in the first block within whose budget it is, so once in all.
    """
    turns: dict[int, np.ndarray] = {}
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])
    for tile in groups_of(batches, _TILE):
        dims, b = tile.column("dims")[0].as_py(), tile.column("block")[0].as_py()
        blocks = _blocks(dims)
        raw = _matrix(tile.column("embedding"), dims)
        at = rotated(raw, turns.setdefault(dims, rotation(dims)))
        rep, size = np.asarray(tile.column("rep")), np.asarray(tile.column("n"))
        gained = np.zeros(len(rep), np.int64)
        forest, out = Forest(), []
        for ask, stand in _sides(tile):
            for left, right in _near_pairs(at[:, blocks[b]], rep, ask, stand, _budget(blocks[b], dims)):
                for j in range(0, len(left), 65_536):
                    x, y = left[j : j + 65_536], right[j : j + 65_536]
                    first = np.ones(len(x), bool)
                    for earlier in blocks[:b]:
                        first &= ~_within(at[x, earlier], at[y, earlier], _budget(earlier, dims))
                    x, y = x[first], y[first]
                    linked = _exact(raw[x], raw[y]) >= COSINE
                    x, y = x[linked], y[linked]
                    np.add.at(gained, x, size[y])
                    np.add.at(gained, y, size[x])
                    for p, q in zip(rep[x].tolist(), rep[y].tolist()):
                        if forest.join(p, q):
                            out.append((p, q, 0))
        for p in np.nonzero(gained)[0]:
            out.append((int(rep[p]), None, int(gained[p])))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), schema)], schema=schema)


def _takes_part() -> Column:
    return usable("embedding") & F.col("label").isNotNull()


def near_duplicates(rows: DataFrame) -> DataFrame:
    """``vec_id, n_links, component`` of every row of ``vec_id, embedding, label`` that takes part.

    Vectors that are equal and have the same label are one class, which is compared once; its members link with
    each other and with all members of linked classes.  A class that holds a third of all rows is one row of the
    join.  A cell with very many classes is cut into tiles.  A first pass has the
    block's coordinates of all classes; only classes near another in a tile go, as whole vectors, to the second.  Links are counted where they are found: no pair
    leaves its task, and of the links between classes only a spanning forest does.
    Classes have numbers of their own, so a vec_id may stand in several; ``component`` is the smallest vec_id of
    the linked classes.  Rows of a class that share a vec_id, or have none, are one vector, and each has a result row.
    """
    members = materialize(
        rows.select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.col("embedding").cast("array<float>").alias("embedding"),
            F.col("label").cast("long").alias("label"),
        ).where(_takes_part())
    )
    classes = materialize(
        members.groupBy("label", "embedding")
        .agg(F.min("vec_id").alias("least"), F.count_distinct(F.struct("vec_id")).alias("n"))
        .withColumn("rep", F.monotonically_increasing_id())
    )
    cells = classes.mapInArrow(
        _cell_batches,
        "label bigint, dims int, block int, cell bigint, home boolean, rep bigint, at array<float>",
    )
    hopeful = materialize(
        tiled(cells, _TILE[:4], "rep", TILE)
        .select(*_TILE, "_part", "home", "rep", "at")
        .mapInArrow(
            _hopeful_batches,
            "label bigint, dims int, block int, cell bigint, _lo int, _hi int, _part int, home boolean, rep bigint",
        )
    )
    found = materialize(
        hopeful.join(classes.select("rep", "n", "embedding"), "rep")
        .repartition(*_TILE)
        .sortWithinPartitions(*_TILE, "_part", "rep")
        .select(*_TILE, "_part", "home", "rep", "n", "embedding")
        .mapInArrow(_tile_batches, "a bigint, b bigint, n bigint")
    )
    counts = found.where("b is null").groupBy("a").agg(F.sum("n").alias("_others"))
    grouped = materialize(components(found.where("b is not null").select("a", "b")))
    named = materialize(
        classes.join(counts, F.col("rep") == F.col("a"), "left")
        .join(grouped, F.col("rep") == F.col("node"), "left")
        .select(
            F.col("label").alias("_label"),
            F.col("embedding").alias("_embedding"),
            "least",
            (F.coalesce("_others", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("_group"),
        )
    )
    smallest = named.groupBy(F.col("_group").alias("_of")).agg(F.min("least").alias("component"))
    known = named.join(smallest, F.col("_group") == F.col("_of"))
    same = (F.col("label") == F.col("_label")) & (F.col("embedding") == F.col("_embedding"))
    return members.join(known, same).select("vec_id", "n_links", "component")


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`near_duplicates` of ``embeddings``; a row that takes no part has no links and is its own component."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    apart = rows.where(~_takes_part()).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col("vec_id").cast("long").alias("component")
    )
    return (
        near_duplicates(rows)
        .unionByName(apart)
        .select(
            "vec_id",
            F.col("n_links").cast("long").alias("n_links"),
            F.col("component").alias("component_id"),
            F.col("vec_id").eqNullSafe(F.col("component")).alias("kept"),
        )
    )


OP8_SQL = """
WITH RECURSIVE e AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e,
    COALESCE(label IS NOT NULL AND LEN([x FOR x IN embedding IF x IS NULL OR NOT ISFINITE(x)]) = 0
      AND LEN([x FOR x IN embedding IF x <> 0]) > 0, FALSE) AS takes_part FROM embeddings),
v AS (SELECT *, ROW_NUMBER() OVER () AS r FROM (SELECT DISTINCT vec_id, label, e FROM e WHERE takes_part)),
links AS (
  SELECT a.r AS a, b.r AS b FROM v a JOIN v b ON a.label = b.label AND a.r <> b.r
  WHERE LIST_COSINE_SIMILARITY(a.e, b.e) >= 98e-2),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
n AS (SELECT a, COUNT(*) AS n FROM links GROUP BY a),
c AS (SELECT a, MIN(vec_id) AS c FROM reach JOIN v ON b = r GROUP BY a),
named AS (
  SELECT vec_id, label, e, COALESCE(n, 0) AS n, LEAST(vec_id, c) AS c FROM v LEFT JOIN n ON r = n.a LEFT JOIN c ON r = c.a),
rows_ AS (
  SELECT e.vec_id, COALESCE(n, 0) AS n_links, CASE WHEN takes_part THEN c ELSE e.vec_id END AS component_id
  FROM e LEFT JOIN named ON takes_part AND e.label = named.label AND e.e = named.e
    AND e.vec_id IS NOT DISTINCT FROM named.vec_id)
SELECT vec_id, n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept FROM rows_
"""
