"""Label indexing, one-hot encoding and vector assembly."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer, OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from ..operators.ordering import global_row_number, global_running_sum
from ..sources.shared import materialize


def fit_index(df: DataFrame, column: str, out: str, unseen: str = "error") -> StringIndexerModel:
    """Number the values of a column by falling frequency, equal ones alphabetically.

    ``unseen`` says what becomes of values not met in training: ``error``, ``skip`` the row
    or ``keep`` them in an index of their own.
    """
    return StringIndexer(
        inputCol=column, outputCol=out, handleInvalid=unseen, stringOrderType="frequencyDesc"
    ).fit(df)


#: A label on this part of the rows or more is joined apart: there are at most as many of them.
HOT_LABELS = 1_000


def label_table(df: DataFrame, column: str) -> DataFrame:
    """A stored table ``value, idx, n`` of a column's values, numbered from 0 by falling frequency, equal ones alphabetically.

    NULL has no number.  Values are counted and numbered in ranges, so no list of them is on the driver.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    numbered = global_row_number(counts, "idx", F.desc("n"), F.col("value"))
    return materialize(numbered.select("value", (F.col("idx") - 1).cast("int").alias("idx"), "n"))


def with_index(df: DataFrame, labels: DataFrame, column: str, out: str) -> DataFrame:
    """The rows of ``df`` whose value has a number, with it.

    Values on very many rows are joined by broadcast, of which there are at most ``HOT_LABELS``, the others by
    an equi join: no value's rows have to meet in one task.
    """
    total = labels.agg(F.sum("n")).scalar()
    hot = labels.withColumn("_hot", F.col("n") * HOT_LABELS >= total)
    few = F.broadcast(hot.where("_hot").select(F.col("value").alias("_value"), F.col("idx").alias(out)))
    rest = hot.where("not _hot").select(F.col("value").alias("_value"), F.col("idx").alias(out))
    same = F.col(column) == F.col("_value")
    return df.join(few, same).union(df.join(few, same, "left_anti").join(rest, same)).drop("_value")


def with_label(df: DataFrame, labels: DataFrame, index: str, out: str) -> DataFrame:
    """The value behind an index; rows whose index belongs to no value are left out."""
    return df.join(labels.select(F.col("idx").alias("_idx"), F.col("value").alias(out)), F.col(index) == F.col("_idx")).drop("_idx")


def encoder_stages(categorical: Sequence[str]) -> list:
    """Index and one-hot encode all columns, in one pass; unseen values get an index of their own."""
    indexed = [f"{c}_index" for c in categorical]
    return [
        StringIndexer(inputCols=list(categorical), outputCols=indexed, handleInvalid="keep"),
        OneHotEncoder(inputCols=indexed, outputCols=[f"{c}_hot" for c in categorical]),
    ]


def assembler(categorical: Sequence[str], numeric: Sequence[str], invalid: str = "keep") -> VectorAssembler:
    """Encoded and numeric columns as one vector.  ``keep`` turns NULL into NaN."""
    return VectorAssembler(
        inputCols=[f"{c}_hot" for c in categorical] + list(numeric), outputCol="features", handleInvalid=invalid
    )


def fit_bins(df: DataFrame, columns: Sequence[str], bins: int) -> Bucketizer:
    """Cut numbers into at most ``bins`` bins: one for each value if there are no more, else with the exact quantiles as edges.

    NULL and NaN are in a bin after the others.
    """
    splits = []
    for c in columns:
        number = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias("v")
        counts = materialize(df.select(number).where("v is not null").groupBy("v").agg(F.count(F.lit(1)).alias("n")))
        few = sorted(r.v for r in counts.select("v").limit(bins + 1).collect())
        if len(few) > bins:
            edges = _even_edges(counts, bins)
        else:
            edges = [(a + b) / 2 for a, b in zip(few, few[1:])] or [0.0]  # the stage asks for two bins
        splits.append([-float("inf"), *edges, float("inf")])
    return Bucketizer(
        splitsArray=splits, inputCols=list(columns), outputCols=[f"{c}_bin" for c in columns], handleInvalid="keep"
    )


def _even_edges(counts: DataFrame, bins: int) -> list[float]:
    """Values ``v`` at the places ``total * i / bins`` of the order, where ``v`` is on ``n`` rows."""
    total = counts.agg(F.sum("n")).scalar()
    before, upto = F.col("n_before") * bins, (F.col("n_before") + F.col("n")) * bins
    first = F.greatest(F.ceil(before / F.lit(total)), F.lit(1))  # the first place that is not before this value
    hit = (first < bins) & (first * F.lit(total) < upto)
    return sorted(r.v for r in global_running_sum(counts, "v", ["n"]).where(hit).select("v").collect())


def one_hot_frame(df: DataFrame, column: str) -> DataFrame:
    """One row per value and vector position of the encoding, with the number of rows.

    The last value is the zero vector, as one position less than values is needed.
    """
    labels = label_table(df, column)
    encoder = OneHotEncoder(inputCol="idx", outputCol="hot").fit(labels.select(F.col("idx").cast("double").alias("idx")))
    encoded = encoder.transform(labels.select(F.col("value").alias(column), "n", F.col("idx").cast("double").alias("idx")))
    return encoded.select(
        column, "n", F.posexplode(vector_to_array("hot")).alias("position", "value")
    )
