"""Centroid clustering of whole-number vectors by equal-average equal-variance search.

Centroids are sorted by the mean of their components.  A vector scans them outward from its own mean: the
squared distance is at least d * (difference of means)^2, so a side is done once that exceeds the
best distance, and at least that plus the squared difference of the deviations, which rejects
single centroids.  What is left is decided by the exact whole-number distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..sources.shared import materialize
from .common import table
from .vectors import as_longs, finite, small, whole, whole_matrix

DIMS, SCALE, CENTROIDS, ROUNDS, SEED = 64, 1024, 8, 10, 3
#: Allowance for rounding of deviations; it only lets a few more centroids through to the exact check.
_SLACK = 1 - 1e-9


class Centroids:
    """Centroids in the order of their component sums, with their deviations."""

    def __init__(self, points: list[list[int]]) -> None:
        self.points = np.array(points, object)
        if small(self.points):
            self.points = self.points.astype(np.int64)
        sums = self.points.sum(axis=1)
        self.order = np.array(sorted(range(len(points)), key=lambda c: (sums[c], c)), np.int64)
        self.sums = sums[self.order]
        self.deviations = _deviations(self.points[self.order], self.sums)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number of the nearest centroid and squared distance of each row, and how many distances that took.

        Ties go to the smaller number: a centroid is rejected only if it must be farther than the best one.
        """
        points = self.points
        if x.dtype != points.dtype:
            x, points = x.astype(object), points.astype(object)
        n, dims = x.shape
        sums = x.sum(axis=1)
        deviations = _deviations(x, sums)
        right = np.searchsorted(self.sums, sums)
        left = right - 1
        best, number = np.full(n, -1, x.dtype), np.full(n, len(points), np.int64)
        active, measured = np.arange(n), 0
        while len(active):
            lo, hi = left[active], right[active]
            has_lo, has_hi = lo >= 0, hi < len(points)
            to_lo = sums[active] - self.sums[np.maximum(lo, 0)]
            to_hi = self.sums[np.minimum(hi, len(points) - 1)] - sums[active]
            take_lo = has_lo & (~has_hi | (to_lo <= to_hi))
            gap = np.where(take_lo, to_lo, to_hi)
            first = number[active] == len(points)
            open_ = (has_lo | has_hi) & (first | (gap * gap <= best[active] * dims))
            active, take_lo, gap, first = active[open_], take_lo[open_], gap[open_], first[open_]
            at = np.where(take_lo, left[active], right[active])
            left[active] -= take_lo
            right[active] += ~take_lo
            spread = deviations[active] - self.deviations[at]
            bound = gap.astype(float) ** 2 + dims * spread * spread
            close = first | (bound * _SLACK <= best[active].astype(float) * dims)
            rows, of = active[close], self.order[at[close]]
            measured += len(rows)
            step = x[rows] - points[of]
            distance = (step * step).sum(axis=1)
            better = (number[rows] == len(points)) | (distance < best[rows]) | (
                (distance == best[rows]) & (of < number[rows])
            )
            best[rows[better]], number[rows[better]] = distance[better], of[better]
        return number, best, measured


def _deviations(x: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Root of the summed squares of the components' distances from their mean."""
    centred = x.astype(float) - (sums.astype(float) / x.shape[1])[:, None]
    return np.sqrt(np.einsum("ij,ij->i", centred, centred))


def _sum_batches(centroids: Centroids, dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [[0] * dims for _ in centroids.points]
        counts = [0] * len(totals)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = whole_matrix(batch.column("x"), dims)
            number, _, _ = centroids.nearest(x)
            for c in np.unique(number).tolist():
                mine = x[number == c]
                counts[c] += len(mine)
                totals[c] = [a + int(b) for a, b in zip(totals[c], mine.sum(axis=0))]
        used = [c for c, n in enumerate(counts) if n]
        rows = [(c, d, Decimal(totals[c][d]), counts[c]) for c in used for d in range(dims)]
        columns = list(zip(*rows)) or [[], [], [], []]
        kinds = [pa.int32(), pa.int32(), pa.decimal128(38, 0), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["cluster", "dim", "total", "n"]
        )

    return run


def _assign_batches(centroids: Centroids, dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            number, distance, _ = centroids.nearest(whole_matrix(batch.column("x"), dims))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(number, pa.int32()), as_longs(distance)],
                ["vec_id", "cluster", "distance"],
            )

    return run


def whole_vectors(rows: DataFrame, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """``vec_id, x`` of the vectors with exactly ``dims`` components, all finite, as whole numbers."""
    at = F.col("embedding")
    kept = rows.select(F.col("vec_id").cast("long").alias("vec_id"), at).where((F.size(at) == dims) & finite("embedding"))
    return kept.select("vec_id", whole("embedding", scale).alias("x"))


def first_points(vectors: DataFrame, k: int = CENTROIDS, seed: int = SEED) -> list[list[int]]:
    """The k vectors with the smallest digests of seed and id, at most so many rows on the driver.

    Rows of equal ids go by their components, and a NULL id comes last.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    found = vectors.withColumn("_digest", digest).orderBy(F.asc_nulls_last("_digest"), "x").limit(k).collect()
    return [list(r.x) for r in found]


def moved(vectors: DataFrame, points: list[list[int]]) -> list[list[int]]:
    """Each centroid at the floor of its vectors' mean; one without vectors stays.

    Every task sums its vectors, so ``centroids * dims`` sums a task are shuffled and as many reach the driver.
    """
    dims = len(points[0])
    partial = vectors.select("x").mapInArrow(
        _sum_batches(Centroids(points), dims), "cluster int, dim int, total decimal(38,0), n bigint"
    )
    out = [list(p) for p in points]
    for c, d, total, n in partial.groupBy("cluster", "dim").agg(F.sum("total"), F.sum("n")).collect():
        out[c][d] = int(total) // n
    return out


def cluster(
    vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED
) -> tuple[DataFrame, list[list[int]]]:
    """``vec_id, cluster, distance`` of every row of ``vec_id, x``, and the centroids after so many rounds.

    All arithmetic is exact.  Vectors are stored once as whole numbers and read once a round; rows of equal ids
    or equal vectors are rows of their own.  With fewer vectors than ``k`` there are fewer centroids, and an
    empty table gives an empty result.  Components beyond a long count as the nearest long; a
    distance beyond a long is NULL.
    """
    vectors = materialize(vectors)
    points = first_points(vectors, k, seed)
    kinds = "vec_id bigint, cluster int, distance bigint"
    if not points:
        return vectors.sparkSession.createDataFrame([], kinds), []
    for _ in range(rounds):
        points = moved(vectors, points)
    return vectors.mapInArrow(_assign_batches(Centroids(points), len(points[0])), kinds), points


def clusters(rows: DataFrame) -> DataFrame:
    """Cluster and distance of every vector, with the sums of its cluster and of all, and its centroid's digest.

    Rows whose vector is NULL, of another length or holds NULL or non-finite components have no result row.  A
    sum that no long can hold, or one over a NULL distance, is NULL.
    """
    assigned, points = cluster(whole_vectors(rows))
    assigned = materialize(assigned)

    whole_sum = F.when(F.count("distance") == F.count(F.lit(1)), F.sum(F.col("distance").cast("decimal(38,0)")))
    sums = assigned.groupBy(F.col("cluster").alias("_of")).agg(whole_sum.alias("_sum"))
    every = Window.partitionBy()  # over at most one row a centroid
    of_all = F.when(F.count("_sum").over(every) == F.count(F.lit(1)).over(every), F.sum("_sum").over(every))
    inertias = sums.select(
        "_of", F.col("_sum").try_cast("bigint").alias("cluster_inertia"), of_all.try_cast("bigint").alias("inertia")
    )
    digests = assigned.sparkSession.createDataFrame(
        [(c, ",".join(map(str, p))) for c, p in enumerate(points)], "_number int, _components string"
    )
    named = inertias.join(digests, F.col("_of") == F.col("_number"))
    return assigned.join(F.broadcast(named), F.col("cluster") == F.col("_of")).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", F.sha2("_components", 256).alias("centroid_sha256")
    )


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`clusters` of ``embeddings``."""
    return clusters(table(spark, sf_dir, "embeddings"))


def _op12_sql() -> str:
    """Ten rounds written out: distances of all pairs, the nearest centroid, floors of exact means."""
    parts = [
        f"""kept AS MATERIALIZED (
  SELECT ROW_NUMBER() OVER () AS r, vec_id, [CAST(FLOOR({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings WHERE LEN(embedding) = {DIMS} AND LEN([x FOR x IN embedding IF x IS NULL OR NOT ISFINITE(x)]) = 0),
v AS MATERIALIZED (SELECT r, UNNEST(RANGE(1, {DIMS + 1})) AS i, UNNEST(v) AS x FROM kept),
first AS (
  SELECT ROW_NUMBER() OVER (ORDER BY SHA256('{SEED}:' || CAST(vec_id AS VARCHAR)) NULLS LAST, v) - 1 AS c, v FROM kept),
c0 AS MATERIALIZED (
  SELECT c, UNNEST(RANGE(1, {DIMS + 1})) AS i, UNNEST(v) AS y FROM first WHERE c < {CENTROIDS})"""
    ]
    for k in range(ROUNDS + 1):
        parts.append(
            f"""a{k} AS MATERIALIZED (
  SELECT r, c, d FROM (SELECT r, c, SUM((x - y) * (x - y)) AS d FROM v JOIN c{k} USING (i) GROUP BY r, c)
  QUALIFY ROW_NUMBER() OVER (PARTITION BY r ORDER BY d, c) = 1)"""
        )
        if k < ROUNDS:
            parts.append(
                f"""c{k + 1} AS MATERIALIZED (
  SELECT c{k}.c, c{k}.i, COALESCE((s - ((s % n) + n) % n) // n, y) AS y FROM c{k} LEFT JOIN (
    SELECT c, i, CAST(SUM(x) AS BIGINT) AS s, COUNT(*) AS n FROM a{k} JOIN v USING (r) GROUP BY c, i) m
  ON c{k}.c = m.c AND c{k}.i = m.i)"""
            )
    last = ROUNDS
    return (
        "WITH "
        + ",\n".join(parts)
        + f""",
named AS (SELECT c, SHA256(STRING_AGG(CAST(y AS VARCHAR), ',' ORDER BY i)) AS h FROM c{last} GROUP BY c)
SELECT vec_id, CAST(a{last}.c AS INT) AS cluster, CAST(d AS BIGINT) AS distance,
  CAST(SUM(d) OVER (PARTITION BY a{last}.c) AS BIGINT) AS cluster_inertia, CAST(SUM(d) OVER () AS BIGINT) AS inertia,
  h AS centroid_sha256
FROM a{last} JOIN kept USING (r) JOIN named ON a{last}.c = named.c"""
    )


OP12_SQL = _op12_sql()
