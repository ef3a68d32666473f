"""Collaborative filtering and recommendations that leave out what was bought."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.numeric import exact_mean
from ..operators.joins import minus_history
from ..operators.ordering import global_row_number
from ..operators.ranking import top_k_per_group
from ..sources.shared import materialize
from .features import with_index, with_label


def interactions(df: DataFrame, labels: DataFrame, user: str, item: str, rating: str) -> DataFrame:
    """One row per user and item: the mean of the user's ratings of it; ``labels`` numbers the items."""
    means = df.groupBy(F.col(user).alias("user_id"), item).agg(exact_mean(rating).alias("rating"))
    return with_index(means, labels, item, "item_id").select("user_id", "item_id", "rating")


def user_history(df: DataFrame, user: str, item: str) -> DataFrame:
    return df.select(F.col(user).alias("user_id"), item).distinct()


def train_als(
    ratings: DataFrame, iterations: int = 10, rank: int = 10, regularization: float = 0.1, seed: int = 42
) -> ALSModel:
    """Non-negative matrix factorization; pairs without factors get no prediction."""
    return ALS(
        maxIter=iterations,
        rank=rank,
        regParam=regularization,
        userCol="user_id",
        itemCol="item_id",
        ratingCol="rating",
        coldStartStrategy="drop",
        nonnegative=True,
        seed=seed,
    ).fit(ratings)


def load_or_train_als(path: str, fit) -> ALSModel:
    """Load saved factors, or train and save them."""
    try:
        return ALSModel.load(path)
    except Exception as e:  # the reader reports a missing path as a Java or an analysis error
        if not isinstance(e, AnalysisException) and "does not exist" not in str(e):
            raise
    model = fit()
    model.write().overwrite().save(path)
    return model


#: Items of a block, which each task holds whole, and items that are compared at once.
BLOCK, STRIP = 65_536, 1_024
#: Scores that a task keeps of its users at once.
_KEPT = 1 << 22


def _norm(column: str) -> Column:
    return F.sqrt(F.aggregate(column, F.lit(0.0).cast("double"), lambda s, x: s + x.cast("double") * x.cast("double")))


def _better(scores: np.ndarray, items: np.ndarray, new: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The best of kept and new scores of each row, best first, equal ones by item; as many as were kept."""
    scores = np.concatenate([scores, new], axis=1)
    items = np.concatenate([items, np.broadcast_to(of, new.shape)], axis=1)
    order = np.lexsort((items, -scores), axis=1)[:, : scores.shape[1] - new.shape[1]]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(items, order, 1)


def _block_batches(items: np.ndarray, factors: np.ndarray, norms: np.ndarray, next_norm: float):
    """Look through a block of items by falling norm; a user stops where norm times norm is below the last kept score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            many = np.asarray(batch.column("k"))
            at = 0
            while at < len(many):  # users with long lists go in few rows
                n = max(1, min(len(many) - at, _KEPT // max(int(many[at : at + 1_024].max()), 1), 1_024))
                yield look(batch.slice(at, n))
                at += n

    def look(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, many = batch.num_rows, np.asarray(batch.column("k"))
        width = int(many.max())
        user = np.asarray(batch.column("features").flatten(), np.float32).reshape(n, -1)
        size = np.asarray(batch.column("norm"))
        scores, found = np.full((n, width), -np.inf, np.float32), np.full((n, width), np.iinfo(np.int32).max, np.int32)
        for i, (s, f) in enumerate(zip(batch.column("scores").to_pylist(), batch.column("items").to_pylist())):
            scores[i, : len(s)], found[i, : len(f)] = s, f
        looked = np.asarray(batch.column("looked")).copy()
        active = np.arange(n)
        for first in range(0, len(items), STRIP):
            last = scores[active, many[active] - 1]
            active = active[size[active] * norms[first] * (1 + 1e-5) + 1e-30 >= last]
            if not len(active):
                break
            strip = slice(first, first + STRIP)
            new = np.einsum("ur,ir->ui", user[active], factors[strip])
            scores[active], found[active] = _better(scores[active], found[active], new, items[strip])
            looked[active] += 1
        last = scores[np.arange(n), many - 1]
        done = (next_norm < 0) | (size * next_norm * (1 + 1e-5) + 1e-30 < last)
        real = [min(int(k), int((s > -np.inf).sum())) for k, s in zip(many, scores)]
        columns = {
            "user_id": batch.column("user_id"),
            "k": batch.column("k"),
            "features": batch.column("features"),
            "norm": batch.column("norm"),
            "scores": pa.array([s[:r] for s, r in zip(scores, real)], pa.list_(pa.float32())),
            "items": pa.array([f[:r] for f, r in zip(found, real)], pa.list_(pa.int32())),
            "looked": pa.array(looked, pa.int64()),
            "done": pa.array(done),
        }
        return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


_STATE = (
    "user_id int, k int, features array<float>, norm double, scores array<float>, items array<int>, looked bigint, done boolean"
)


def best_items(model: ALSModel, wanted: DataFrame) -> DataFrame:
    """``user_id, item_id, predicted_rating, looked``: for ``(user_id, k)`` the k items of highest predicted rating.

    Exact, without pairing all users with all items: no score is above the product of the two norms, so
    items are looked through by falling norm, in strips, until a user's k-th score is above what is left.  ``looked``
    counts the strips.  Items come in blocks of bounded size, which tasks hold whole; between blocks, users that
    are done leave.  Equal scores go by item id.  Users without factors are left out.
    """
    rank = model.rank
    catalogue = materialize(model.itemFactors.select(F.col("id").cast("int").alias("id"), "features", _norm("features").alias("norm")))
    numbered = materialize(global_row_number(catalogue, "place", F.desc("norm"), F.col("id")))
    blocks = -(-numbered.count() // BLOCK)
    tops = {r[0]: r[1] for r in numbered.groupBy(F.floor((F.col("place") - 1) / BLOCK).alias("b")).agg(F.max("norm")).collect()}
    users = model.userFactors.select(F.col("id").cast("int").alias("id"), "features", _norm("features").alias("norm"))
    wanted = wanted.select(F.col("user_id").cast("int").alias("user_id"), F.col("k").cast("int").alias("k"))
    state = (
        wanted.join(users, F.col("user_id") == F.col("id"))
        .withColumns(
            {
                "scores": F.array().cast("array<float>"),
                "items": F.array().cast("array<int>"),
                "looked": F.lit(0).cast("bigint"),
                "done": F.lit(False),
            }
        )
        .drop("id")
    )
    finished = None
    for b in range(blocks):
        rows = numbered.where((F.col("place") > b * BLOCK) & (F.col("place") <= (b + 1) * BLOCK)).orderBy("place").toArrow()
        ids = np.asarray(rows.column("id"), np.int32)
        factors = np.asarray(rows.column("features").combine_chunks().flatten(), np.float32).reshape(-1, rank)
        run = _block_batches(ids, factors, np.asarray(rows.column("norm")), tops.get(b + 1, -1.0))
        state = materialize(state.mapInArrow(run, _STATE))
        left = state.where("done")
        finished = left if finished is None else finished.union(left)
        state = state.where("not done")
        if b + 1 < blocks and state.isEmpty():
            break
    if finished is None:
        finished = wanted.sparkSession.createDataFrame([], _STATE)
    pairs = F.arrays_zip(F.col("items").alias("item_id"), F.col("scores").alias("predicted_rating"))
    return finished.select("user_id", F.inline(pairs), "looked")


def recommend_all(model: ALSModel, n: int) -> DataFrame:
    """The best ``n`` items of every user as rows."""
    users = model.userFactors.select(F.col("id").alias("user_id"), F.lit(n).alias("k"))
    return best_items(model, users).drop("looked")


def novel_recommendations(
    model: ALSModel, history: DataFrame, labels: DataFrame, item: str, k: int = 3
) -> DataFrame:
    """The best ``k`` items per user among those the user has not bought.

    ``history`` holds ``user_id`` and ``item_id``.  A user with ``h`` bought items has ``k`` new ones among the
    best ``k + h``, and no more are asked for.  Users with long lists are dealt apart from the others.
    """
    bought = materialize(history.distinct())
    users = bought.groupBy("user_id").agg((F.count(F.lit(1)) + k).cast("int").alias("k"))
    candidates = best_items(model, users.repartitionByRange("k", "user_id")).drop("looked")
    fresh = minus_history(candidates, bought, ["user_id", "item_id"])
    best = top_k_per_group(fresh, ["user_id"], [F.desc("predicted_rating"), "item_id"], k, out="rank")
    return with_label(best, labels, "item_id", item).select("user_id", item, "predicted_rating", "rank")


def popular_unseen(history: DataFrame, item: str, k: int = 3) -> DataFrame:
    """The ``k`` most popular items per user among those the user has not bought.

    Items are numbered by popularity.  What a user lacks are the gaps between the numbers
    of the bought items, and only the first ``k`` numbers of a gap can matter, so the work
    is proportional to the history and no user is paired with the whole catalogue.
    """
    buyers = history.groupBy(item).agg(F.count(F.lit(1)).alias("buyers"))
    catalogue = materialize(global_row_number(buyers, "place", F.desc("buyers"), F.col(item)))
    size = catalogue.agg(F.count(F.lit(1))).scalar()
    w = Window.partitionBy("user_id").orderBy("place")
    bought = history.join(catalogue, item).select("user_id", "place").withColumn("size", size)
    before = F.coalesce(F.lag("place").over(w), F.lit(0))
    gaps = bought.withColumns({"before": before, "is_last": F.lead("place").over(w).isNull()})

    def places(start, end):
        return F.when(start <= end, F.sequence(start, end)).otherwise(F.array().cast("array<bigint>"))

    inner = places(F.col("before") + 1, F.least(F.col("place") - 1, F.col("before") + k))
    tail = F.when(
        F.col("is_last"), places(F.col("place") + 1, F.least(F.col("size"), F.col("place") + k))
    ).otherwise(F.array().cast("array<bigint>"))
    missing = gaps.select("user_id", F.explode(F.concat(inner, tail)).alias("place"))
    return (
        top_k_per_group(missing, ["user_id"], ["place"], k, out="rank")
        .join(catalogue, "place")
        .select("user_id", item, "buyers", "rank")
    )
