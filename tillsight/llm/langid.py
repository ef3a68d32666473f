"""Language identification by error-correcting output codes.

Every language has a codeword.  For each bit a linear classifier over hashed byte n-grams is
fitted, and a text goes to the language whose codeword is nearest to the bits' margins under a
weighted loss.  Texts whose second nearest codeword is about as near are flagged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import in_fold, sampled, table

#: Labelled documents of a language that the bits are fitted on, at most; they are chosen by a hash of the id.
PER_LANGUAGE = 400
#: Byte trigrams are hashed to so many features.
FEATURES = 4_096
#: Random spans of a few words are taken from each of those documents as well, for short texts.
SPANS, SPAN_WORDS = 2, (2, 12)
#: A text is ambiguous if the second nearest codeword has over this part of the nearest one's share.
AMBIGUOUS = 0.5
SEED = 11

_ASCII_LETTER = re.compile("[A-Za-z]")


def has_letter(text: str) -> bool:
    return bool(_ASCII_LETTER.search(text)) or any(map(str.isalpha, text))


def counts(text: str) -> np.ndarray:
    """Hashed byte trigrams of a whole text in lower case, with a space at both ends."""
    x = np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), np.uint8).astype(np.uint32)
    if len(x) < 3:
        return np.zeros(FEATURES, np.int64)
    key = x[:-2] * np.uint32(0x9E3779B1) + x[1:-1] * np.uint32(0x85EBCA77) + x[2:] * np.uint32(0xC2B2AE3D)
    key ^= key >> np.uint32(15)
    key *= np.uint32(0x2C1B3C6D)
    return np.bincount(key >> np.uint32(20), minlength=FEATURES)


def scaled(rows: np.ndarray) -> np.ndarray:
    """Square roots of counts, at unit length."""
    x = np.sqrt(rows.astype(np.float32))
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-9)


def codewords(languages: int) -> np.ndarray:
    """A word of +1 and -1 per language.

    Up to six languages get every way to part them in two; more get seeded random words.
    """
    if languages <= 1:
        return np.ones((languages, 1), np.float32)
    if languages <= 6:
        ways = [w for w in product((-1, 1), repeat=languages) if w[0] == 1 and -1 in w]
        return np.array(ways, np.float32).T
    bits = int(np.ceil(10 * np.log2(languages)))
    random = np.random.default_rng(SEED)
    while True:
        words = np.where(random.random((languages, bits)) < 0.5, -1, 1).astype(np.float32)
        distinct = len(np.unique(words, axis=0)) == languages
        if distinct and (np.abs(words.sum(axis=0)) < languages).all():
            return words


def _sample_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features of whole texts and of spans of a few words, as lists of positions and counts."""
    for batch in batches:
        lang, at, n = [], [], []
        for doc_id, text, label in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "lang"))):
            random = np.random.default_rng([SEED, abs(doc_id)])
            words = text.split()
            texts = [text]
            for _ in range(SPANS if words else 0):
                size = int(random.integers(SPAN_WORDS[0], SPAN_WORDS[1] + 1))
                start = int(random.integers(0, max(1, len(words) - size + 1)))
                texts.append(" ".join(words[start : start + size]))
            for t in texts:
                row = counts(t)
                some = np.nonzero(row)[0]
                lang.append(label)
                at.append(some.astype(np.int32))
                n.append(row[some].astype(np.int32))
        ints = pa.list_(pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(at, ints), pa.array(n, ints)], ["lang", "at", "n"])


class Model:
    """Languages with their codewords, the bits' weights, and how far each bit is trusted for each language."""

    def __init__(self, languages, words, weights, trust) -> None:
        self.languages, self.words, self.weights, self.trust = languages, words, weights, trust

    def shares(self, x: np.ndarray) -> np.ndarray:
        """Share of each language: near codewords, by the weighted loss of the margins, have large ones."""
        margins = x @ self.weights[:-1] + self.weights[-1]
        loss = np.log1p(np.exp(-np.clip(margins[:, None, :] * self.words[None], -30, 30)))
        distance = (loss * self.trust[None]).sum(axis=2)
        away = np.exp(-(distance - distance.min(axis=1, keepdims=True)) * self.words.shape[1] / 2)
        return away / away.sum(axis=1, keepdims=True)


def fit(docs: DataFrame, lang: str = "lang") -> Model:
    """Fit on the given labelled rows; at most ``PER_LANGUAGE`` documents of a language reach the driver, as features.

    Of the rows that repeat an id in a language, the one with the smallest hash of the text counts.
    """
    labelled = docs.where(f"{lang} is not null and text is not null and doc_id is not null")
    ids = labelled.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(lang).cast("string").alias("lang"))
    chosen = sampled(ids, "lang", "doc_id", PER_LANGUAGE, SEED)
    # at most PER_LANGUAGE ids of each language, so the ids may be broadcast
    texts = labelled.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col(lang).cast("string").alias("lang"))
    rows = (
        texts.join(F.broadcast(chosen), ["doc_id", "lang"])
        .groupBy("doc_id", "lang")
        .agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
        .select("doc_id", "text", "lang")
        .mapInArrow(_sample_batches, "lang string, at array<int>, n array<int>")
        .toArrow()
    )
    labels = np.array(rows.column("lang").to_pylist(), object)
    languages = sorted(set(labels.tolist()))
    words = codewords(len(languages))
    x = np.zeros((rows.num_rows, FEATURES), np.float32)
    for i, (at, n) in enumerate(zip(rows.column("at"), rows.column("n"))):
        x[i, at.values.to_numpy()] = n.values.to_numpy()
    x = scaled(x)
    order = np.lexsort([x @ np.arange(FEATURES, dtype=np.float32), labels])  # arrival order must not matter
    x, labels = x[order], labels[order]
    which = np.array([languages.index(v) for v in labels], int)
    weights = np.zeros((FEATURES + 1, words.shape[1]), np.float32)
    if len(languages) > 1:
        targets = words[which] > 0
        balance = (1.0 / np.bincount(which))[which].astype(np.float32)[:, None]
        balance /= balance.sum()
        mean, square = np.zeros_like(weights), np.zeros_like(weights)
        for step in range(1, 201):
            p = 1 / (1 + np.exp(-(x @ weights[:-1] + weights[-1])))
            gap = (p - targets) * balance
            slope = np.vstack([x.T @ gap, gap.sum(axis=0)]) + 1e-6 * weights
            mean = 0.9 * mean + 0.1 * slope
            square = 0.99 * square + 0.01 * slope * slope
            weights -= 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
    margins = x @ weights[:-1] + weights[-1]
    trust = np.ones(words.shape, np.float32)
    for k in range(len(languages)):
        trust[k] = (margins[which == k] * words[k] > 0).mean(axis=0) + 0.01
    trust /= np.maximum(trust.sum(axis=1, keepdims=True), 1e-9)
    return Model(languages, words, weights, trust)


def _predict_batches(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            lang, score, unsure = ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
            some = [i for i, t in enumerate(texts) if t and model.languages and has_letter(t)]
            for i in range(0, len(some), 256):
                rows = some[i : i + 256]
                share = model.shares(scaled(np.stack([counts(texts[r]) for r in rows])))
                best = np.argmax(share, axis=1)
                top = np.take_along_axis(share, best[:, None], 1)[:, 0]
                second = np.sort(share, axis=1)[:, -2] if share.shape[1] > 1 else np.zeros(len(rows))
                for r, k in zip(rows, best):
                    lang[r] = model.languages[k]
                score[rows], unsure[rows] = top, second > AMBIGUOUS * top
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(lang), pa.array(score), pa.array(unsure)],
                ["doc_id", "held_out", "lang_pred", "score", "ambiguous"],
            )

    return run


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, ambiguous`` of rows with ``doc_id, text, held_out``.

    A NULL text, or one without a letter, is ``und`` with score 0; all texts are if nothing was learned.
    The model has a fixed number of features for each bit and travels with the task.
    """
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), "held_out").mapInArrow(
        _predict_batches(model), "doc_id bigint, held_out boolean, lang_pred string, score double, ambiguous boolean"
    )


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every row of ``documents``, learned outside the evaluation fold."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", in_fold("doc_id", 4, 2))
    return predict(docs, fit(docs.where("not held_out")))
