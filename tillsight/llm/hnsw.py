"""Approximate nearest neighbours by hierarchical navigable small-world graphs, one for each shard.

Distinct vectors are dealt to shards of a bounded size.  A shard's graph is a few flat arrays,
stored as bytes in a table.  Every query is looked up in every shard, and the shards' results are merged.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..sources.shared import materialize
from .common import groups_of, table
from .vectors import valid

#: Vectors of a shard, about.
SHARD = 4_096
#: Queries that are looked up together.
BLOCK = 512
#: Neighbours of a node in upper layers (twice that in the lowest, and the next node), and widths of the search.
DEGREE, BUILD, SEARCH = 12, 48, 128
SEED = 3


class Graph:
    """``links[l][i]``: neighbours of node i in layer l, filled up with -1; ``level[i]``: its highest layer."""

    def __init__(self, vectors: np.ndarray, level: np.ndarray, links: list[np.ndarray], entry: int) -> None:
        self.vectors, self.level, self.links, self.entry = vectors, level, links, entry
        self.squares = np.einsum("ij,ij->i", vectors, vectors)

    def _distances(self, query: np.ndarray, square: float, rows) -> np.ndarray:
        return self.squares[rows] - 2 * (self.vectors[rows] @ query) + square

    def _walk(self, query: np.ndarray, square: float, start: list[tuple[float, int]], width: int, layer: int) -> list:
        """The ``width`` nearest found from the start, as (distance, node), nearest first."""
        seen = bytearray(len(self.vectors))
        for _, i in start:
            seen[i] = 1
        todo, best = list(start), [(-d, i) for d, i in start]
        heapq.heapify(todo)
        heapq.heapify(best)
        links = self.links[layer]
        while todo:
            d, at = heapq.heappop(todo)
            if d > -best[0][0] and len(best) >= width:
                break
            new = [i for i in links[at].tolist() if i >= 0 and not seen[i]]
            if not new:
                continue
            for i in new:
                seen[i] = 1
            for e, i in zip(self._distances(query, square, new).tolist(), new):
                if len(best) < width:
                    heapq.heappush(best, (-e, i))
                    heapq.heappush(todo, (e, i))
                elif e < -best[0][0]:
                    heapq.heapreplace(best, (-e, i))
                    heapq.heappush(todo, (e, i))
        return sorted((-d, i) for d, i in best)

    def search(self, query: np.ndarray, k: int, width: int = SEARCH) -> list[int]:
        """About the k nearest nodes."""
        query = query.astype(np.float32)
        square = float(query @ query)
        found = [(float(self._distances(query, square, [self.entry])[0]), self.entry)]
        for layer in range(len(self.links) - 1, 0, -1):
            found = self._walk(query, square, found[:1], 1, layer)
        return [i for _, i in self._walk(query, square, found, max(width, k), 0)[:k]]

    def _spread(self, candidates: list[tuple[float, int]], most: int) -> list[int]:
        """Near candidates, but none that is nearer to a chosen one than to the node; then the nearest others."""
        rows = [i for _, i in candidates]
        x = self.vectors[rows]
        between = self.squares[rows][:, None] - 2 * (x @ x.T) + self.squares[rows][None]
        chosen: list[int] = []
        nearest = np.full(len(rows), np.inf)
        for n, (d, _) in enumerate(candidates):
            if len(chosen) == most:
                break
            if d <= nearest[n]:
                chosen.append(n)
                np.minimum(nearest, between[n], out=nearest)
        if len(chosen) < most:
            have = set(chosen)
            chosen += [n for n in range(len(rows)) if n not in have][: most - len(chosen)]
        return [rows[n] for n in chosen]

    def _connect(self, node: int, other: int, layer: int) -> None:
        links = self.links[layer]
        free = np.nonzero(links[other] < 0)[0]
        if len(free):
            links[other][free[0]] = node
            return
        rows = [*links[other].tolist(), node]
        gaps = self._distances(self.vectors[other], float(self.squares[other]), rows).tolist()
        kept = self._spread(sorted(zip(gaps, rows)), links.shape[1])
        links[other][:] = -1
        links[other][: len(kept)] = kept


def build(vectors: np.ndarray) -> Graph:
    """Insert the rows one by one; levels are drawn from a fixed seed."""
    n = len(vectors)
    random = np.random.default_rng(SEED)
    level = np.minimum((-np.log(1 - random.random(n)) / np.log(DEGREE)).astype(np.int32), 5)
    top = int(level.max()) if n else 0
    links = [np.full((n, DEGREE * (2 if layer == 0 else 1)), -1, np.int32) for layer in range(top + 1)]
    graph = Graph(vectors.astype(np.float32), level, links, 0)
    for node in range(1, n):
        query, square = graph.vectors[node], float(graph.squares[node])
        high = int(level[graph.entry])
        found = [(float(graph._distances(query, square, [graph.entry])[0]), graph.entry)]
        for layer in range(high, int(level[node]), -1):
            found = graph._walk(query, square, found[:1], 1, layer)
        for layer in range(min(high, int(level[node])), -1, -1):
            found = graph._walk(query, square, found, BUILD, layer)
            near = graph._spread(found, DEGREE)
            links[layer][node][: len(near)] = near
            for other in near:
                graph._connect(node, other, layer)
        if level[node] > high:
            graph.entry = node
    # every node can be reached: a search as wide as the graph finds all of it
    after = np.roll(np.arange(n, dtype=np.int32), -1)
    after[(links[0] == after[:, None]).any(axis=1)] = -1
    links[0] = np.column_stack([links[0], after])
    return graph


_INDEX = "dims int, shard int, rows int, entry int, classes binary, vectors binary, level binary, links binary"


def _build_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row of the index for each shard of a partition, whose rows go by shard and ``rep``."""
    for rows in groups_of(batches, ["dims", "shard"]):
        dims, shard = rows.column("dims")[0].as_py(), rows.column("shard")[0].as_py()
        flat = rows.column("embedding").combine_chunks().flatten()
        graph = build(np.asarray(flat, np.float32).reshape(-1, dims))
        made = {
            "dims": dims,
            "shard": shard,
            "rows": rows.num_rows,
            "entry": graph.entry,
            "classes": np.asarray(rows.column("rep"), np.int64).tobytes(),
            "vectors": graph.vectors.tobytes(),
            "level": graph.level.tobytes(),
            "links": b"".join(x.tobytes() for x in graph.links),
        }
        types = [pa.int32()] * 4 + [pa.binary()] * 4
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(made.values(), types)], names=list(made))


def _load(row: dict) -> tuple[Graph, np.ndarray]:
    n = row["rows"]
    level = np.frombuffer(row["level"], np.int32)
    flat, links, at = np.frombuffer(row["links"], np.int32), [], 0
    for layer in range(int(level.max()) + 1):
        width = DEGREE if layer else 2 * DEGREE + 1
        links.append(flat[at : at + n * width].reshape(n, width))
        at += n * width
    vectors = np.frombuffer(row["vectors"], np.float32).reshape(n, row["dims"])
    return Graph(vectors, level, links, row["entry"]), np.frombuffer(row["classes"], np.int64)


def _search_batches(k: int):
    schema = pa.schema([("query_id", pa.int64()), ("rep", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                graph, classes = _load(row)
                ids, reps, scores = [], [], []
                for query in row["queries"]:
                    vector = np.array(query["embedding"], np.float64)
                    found = graph.search(vector, k)
                    gap = graph.vectors[found].astype(np.float64) - vector
                    ids += [query["vec_id"]] * len(found)
                    reps += classes[found].tolist()
                    scores += np.sqrt((gap * gap).sum(axis=1)).tolist()
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(reps, pa.int64()), pa.array(scores, pa.float64())], schema=schema)

    return run


def classes_of(vectors: DataFrame, most: int) -> DataFrame:
    """``rep, dims, embedding, ids``: each distinct vector with its ``most`` smallest ids.

    More are never needed to list as many neighbours.  The rank limit works before the shuffle, so a vector
    that fills a third of the table sends ``most`` ids from each task.
    """
    order = Window.partitionBy("embedding").orderBy("vec_id")
    return (
        vectors.withColumn("_row", F.row_number().over(order))
        .where(F.col("_row") <= most)
        .groupBy("embedding")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .select(F.col("ids")[0].alias("rep"), F.size("embedding").alias("dims"), "embedding", "ids")
    )


def build_index(classes: DataFrame) -> DataFrame:
    """The stored index, one row per shard.  Every class is in one shard; shards share one length of vectors."""
    shards = F.ceil(F.col("_n") / F.lit(SHARD)).cast("int")
    sizes = classes.groupBy("dims").agg(F.count(F.lit(1)).alias("_n"))  # one row a length of vectors
    before = F.sum(shards).over(Window.orderBy("dims")) - shards
    numbered = materialize(sizes.select("dims", shards.alias("_shards"), before.cast("int").alias("_first")))
    dealt = classes.join(numbered, "dims").select(
        "dims", F.pmod(F.xxhash64("rep"), "_shards").cast("int").alias("shard"), "_first", "rep", "embedding"
    )
    made = numbered.agg(F.sum("_shards")).first()[0] or 1
    # a task of its own for each shard: shards are small in bytes but dear to build
    spread = dealt.repartitionById(int(made), F.col("_first") + F.col("shard")).sortWithinPartitions("dims", "shard", "rep")
    return materialize(spread.select("dims", "shard", "rep", "embedding").mapInArrow(_build_batches, _INDEX))


def nearest(rows: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each of ``queries`` (vec_id, embedding) its k nearest in ``rows``.

    Blocks of queries, of a bounded size, are sent to every shard.  A query does not find itself; equal distances go
    by vec_id.  Of a vec_id on several rows the nearest counts.  Vectors of another length are not compared.
    """
    classes = materialize(classes_of(valid(rows), k + 1))
    index = build_index(classes)
    asked = valid(queries).withColumn("dims", F.size("embedding"))
    counted = asked.groupBy("dims").agg(F.count(F.lit(1)).alias("_n"))
    blocks = F.ceil(F.col("_n") / F.lit(BLOCK)).cast("int")
    packed = (
        asked.join(counted, "dims")
        .withColumn("block", F.pmod(F.xxhash64("vec_id", "embedding"), blocks))
        .groupBy("dims", "block")
        .agg(F.collect_list(F.struct("vec_id", "embedding")).alias("queries"))
    )
    to_shards = packed.join(index.select("dims", "shard"), "dims")
    found = to_shards.join(index, ["dims", "shard"]).mapInArrow(
        _search_batches(k + 1), "query_id bigint, rep bigint, score double"
    )
    best = Window.partitionBy("query_id").orderBy("score", "rep")
    near = found.withColumn("_row", F.row_number().over(best)).where(F.col("_row") <= k + 1)
    copies = near.join(classes.select("rep", F.explode("ids").alias("vec_id")), "rep").where("vec_id <> query_id")
    single = copies.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        single.withColumn("rank", F.row_number().over(rank))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(rows, rows.where("vec_id % 100 = 0"))
