"""Quality classifier: a convolutional network over bytes, in numpy.

Filters slide over the bytes of a text.  A chunk keeps the highest response of each filter; chunks
overlap and cover the whole text.  Mean and maximum of the chunks' responses give one probability.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import in_fold, sampled, table

#: Labelled documents of each class that the network is fitted on, at most; chosen by a hash of the id.
PER_CLASS = 1_200
#: Passes over those documents, and documents of a step; each is looked at with all of its chunks.
EPOCHS, STEP = 16, 64
#: Part of the looks that show the beginning of a chunk as if it were a whole text, for the sake of short texts.
SHORT = 0.3
FILTERS, WIDTH = 16, 5
#: A chunk is four cells of bytes; the next one begins three cells on, so that chunks overlap.
CELL, CELLS, STRIDE = 64, 4, 3
SEED = 5
#: Bytes whose responses are held at once.
_HELD = 1 << 17


def padded(text: str | None) -> np.ndarray:
    """Bytes of a text, with zeros up to whole cells that can be cut into chunks."""
    raw = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
    cells = max(CELLS, -(-len(raw) // CELL))
    cells += -(cells - CELLS) % STRIDE
    out = np.zeros(cells * CELL, np.uint8)
    out[: len(raw)] = raw
    return out


class Network:
    """``taps[j, b, f]``: response of filter f to byte b in place j; ``out``: weights of mean, maximum and the constant."""

    def __init__(self, taps: np.ndarray, bias: np.ndarray, out: np.ndarray) -> None:
        self.taps, self.bias, self.out = taps, bias, out

    def cells(self, x: np.ndarray) -> np.ndarray:
        """Highest responses in each cell; a filter that starts in a cell may end in the next one."""
        n = len(x)
        tail = np.concatenate([x, np.zeros(WIDTH - 1, np.uint8)])
        made = np.empty((n // CELL, FILTERS), np.float32)
        for start in range(0, n, _HELD):
            m = min(_HELD, n - start)
            response = self.taps[0][tail[start : start + m]]
            for j in range(1, WIDTH):
                response += self.taps[j][tail[start + j : start + j + m]]
            made[start // CELL : (start + m) // CELL] = response.reshape(-1, CELL, FILTERS).max(axis=1)
        return np.maximum(made + self.bias, 0)

    def features(self, text: str | None) -> np.ndarray:
        cells = self.cells(padded(text))
        starts = np.arange(0, len(cells) - CELLS + 1, STRIDE)
        chunks = cells[starts]
        for k in range(1, CELLS):
            chunks = np.maximum(chunks, cells[starts + k])
        return np.concatenate([chunks.mean(axis=0), chunks.max(axis=0), np.ones(1, np.float32)])

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.features(text) @ self.out, -30, 30))))


def _tops(p: dict[str, np.ndarray], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Highest response of each filter in each cell of ``x``, and the byte where it starts, in blocks of bounded size."""
    tail = np.concatenate([x, np.zeros(WIDTH - 1, np.uint8)])
    top, place = np.empty((len(x) // CELL, FILTERS), np.float32), np.empty((len(x) // CELL, FILTERS), np.int64)
    for start in range(0, len(x), _HELD):
        m = min(_HELD, len(x) - start)
        response = p["taps"][0][tail[start : start + m]]
        for j in range(1, WIDTH):
            response += p["taps"][j][tail[start + j : start + j + m]]
        response = response.reshape(-1, CELL, FILTERS)
        at = response.argmax(axis=1)
        cells = slice(start // CELL, (start + m) // CELL)
        top[cells] = np.take_along_axis(response, at[:, None], 1)[:, 0]
        place[cells] = at + np.arange(start, start + m, CELL)[:, None]
    return top + p["bias"], place


def slopes(
    p: dict[str, np.ndarray], docs: list[np.ndarray], good: np.ndarray, weight: np.ndarray
) -> tuple[float, dict[str, np.ndarray]]:
    """Weighted log loss of padded documents, all their chunks seen as in scoring, and its gradient.

    The gradient of a maximum goes to the place that had it, so few bytes of a chunk have a part in it.
    """
    rest = np.zeros(CELL, np.uint8)  # what follows a document is empty, as in scoring
    x = np.concatenate([part for d in docs for part in (d, rest)])
    top, place = _tops(p, x)
    first, starts, ends = 0, [], []
    for d in docs:
        starts.append(first + np.arange(0, len(d) // CELL - CELLS + 1, STRIDE))
        ends.append(len(starts[-1]))
        first += len(d) // CELL + 1
    of = np.repeat(np.arange(len(docs)), ends)
    cells = np.concatenate(starts)[:, None] + np.arange(CELLS)  # of each chunk
    best = top[cells].argmax(axis=1)
    cell = np.take_along_axis(cells, best, 1)
    columns = np.arange(FILTERS)[None]
    chunk = np.maximum(top[cell, columns], 0)
    number = np.array(ends, np.float32)[:, None]
    begin = np.concatenate([[0], np.cumsum(ends)[:-1]])
    mean, highest = np.add.reduceat(chunk, begin) / number, np.maximum.reduceat(chunk, begin)
    which = np.stack([chunk[b : b + n].argmax(axis=0) + b for b, n in zip(begin, ends)])
    seen = np.concatenate([mean, highest, np.ones((len(docs), 1), np.float32)], axis=1)
    odds = np.clip(seen @ p["out"], -30, 30)
    loss = float((weight * (np.logaddexp(0, odds) - good * odds)).sum() / len(docs))
    gap = ((1 / (1 + np.exp(-odds)) - good) * weight / len(docs)).astype(np.float32)
    back = gap[:, None] * p["out"][None]
    to_chunk = (back[:, :FILTERS] / number)[of]
    np.add.at(to_chunk, (which, np.broadcast_to(columns, which.shape)), back[:, FILTERS : 2 * FILTERS])
    to_chunk *= chunk > 0
    at = place[cell, columns]
    out = {"out": seen.T @ gap, "bias": to_chunk.sum(axis=0), "taps": np.zeros_like(p["taps"])}
    full = np.concatenate([x, np.zeros(WIDTH - 1, np.uint8)])
    wide = np.broadcast_to(columns, at.shape)
    for j in range(WIDTH):
        np.add.at(out["taps"][j], (full[at + j], wide), to_chunk)
    return loss, out


def _beginning(doc: np.ndarray, random: np.random.Generator) -> np.ndarray:
    """The first bytes of one of a document's chunks, as a text of its own."""
    size = CELL * CELLS
    start = int(random.integers(0, (len(doc) - size) // (STRIDE * CELL) + 1)) * STRIDE * CELL
    return np.where(np.arange(size) < random.integers(10, size), doc[start : start + size], 0).astype(np.uint8)


def train(texts: list[bytes], good: np.ndarray, random: np.random.Generator | None = None) -> Network:
    """Fit by Adam, each document seen whole once an epoch or by the beginning of a chunk; both classes weigh alike."""
    random = random or np.random.default_rng(SEED)
    p = {
        "taps": random.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32),
        "bias": np.zeros(FILTERS, np.float32),
        "out": random.normal(0, 0.1, 2 * FILTERS + 1).astype(np.float32),
    }
    mean, square, step = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}, 0
    docs = [padded(t.decode("utf-8", "replace")) for t in texts]
    weight = (np.where(good, 0.5 / max(1, good.sum()), 0.5 / max(1, (~good).sum())) * len(good)).astype(np.float32)
    for epoch in range(EPOCHS):
        order = random.permutation(len(docs))
        for at in range(0, len(order), STEP):
            rows = order[at : at + STEP]
            short = random.random(len(rows)) < SHORT
            looks = [_beginning(docs[r], random) if s else docs[r] for r, s in zip(rows, short)]
            _, slope = slopes(p, looks, good[rows].astype(np.float32), weight[rows])
            step += 1
            for k, v in p.items():
                g = slope[k] + (1e-4 * v if k == "out" else 0)
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.99 * square[k] + 0.01 * g * g
                rate = 0.02 * (1 - epoch / EPOCHS)
                v -= rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-6)
    return Network(p["taps"], p["bias"], p["out"])


def fit(docs: DataFrame, labels: DataFrame) -> Network | None:
    """Fit on at most ``PER_CLASS`` documents of each class, with their whole texts; None if a class has none.

    Labels of the evaluation fold are not looked at.  A document with two labels counts as the lower one, and of the
    rows that repeat an id the one with the smallest hash of the text.
    """
    labelled = (
        labels.where("doc_id is not null and quality in (0, 1)")
        .where(~in_fold("doc_id", 3, 1))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min(F.col("quality").cast("int")).alias("quality"))
    )
    chosen = sampled(labelled, "quality", "doc_id", PER_CLASS, SEED)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # two classes of at most PER_CLASS rows: a proven bound
    rows = (
        texts.join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "quality")
        .agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
        .select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("raw"), "quality")
        .toArrow()
        .to_pylist()
    )
    rows.sort(key=lambda r: (r["doc_id"], r["raw"]))
    good = np.array([r["quality"] == 1 for r in rows], bool)
    if good.all() or not good.any():
        return None
    return train([r["raw"] for r in rows], good)


def _score_batches(model: Network | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [0.5 if model is None else model.score(t.as_py()) for t in batch.column("text")]
            columns = {n: batch.column(n) for n in batch.schema.names} | {"score": pa.array(scores, pa.float64())}
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


def scores(docs: DataFrame, model: Network | None) -> DataFrame:
    """The given columns with ``score``; 0.5 everywhere if there was nothing to learn from.

    Every byte of a text is seen; a NULL text is scored as an empty one.  Nothing is shuffled.
    """
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(_score_batches(model), f"{kinds}, score double")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are scored as good; a column named ``score`` of their own stays."""
    model = fit(docs, labels)
    names = docs.columns
    aside = docs.toDF(*["text" if n == "text" else f"d{i}" for i, n in enumerate(names)])
    kept = scores(aside, model).where("score >= 0.5")
    return kept.select(*[F.col("text" if n == "text" else f"d{i}").alias(n) for i, n in enumerate(names)])


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every row of ``documents`` by a network fitted on the labels outside the evaluation fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    rows = docs.select(F.col("doc_id").cast("long"), in_fold("doc_id", 3, 1).alias("held_out"), F.col("text").cast("string"))
    scored = scores(rows, model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
