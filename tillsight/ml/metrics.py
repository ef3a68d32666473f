"""Model quality as Spark aggregates over a prediction frame."""

from __future__ import annotations

from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    MulticlassClassificationEvaluator,
    RegressionEvaluator,
)
from pyspark.sql import DataFrame, functions as F

from ..functions.numeric import ratio, round_half_up
from ..operators.ordering import global_running_sum


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows per label and predicted label."""
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def classification_metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction", digits: int = 6
) -> DataFrame:
    """Accuracy and weighted precision, recall and F1, from one pass over the predictions.

    Everything after the confusion matrix has at most one row per pair of classes.
    """
    cells = confusion(df, label, prediction).select(
        F.explode(
            F.array(
                F.struct(
                    F.col("label").alias("class"),
                    F.col("n").alias("actual"),
                    F.lit(0).cast("long").alias("predicted"),
                    F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("hits"),
                ),
                F.struct(
                    F.col("prediction").alias("class"),
                    F.lit(0).cast("long").alias("actual"),
                    F.col("n").alias("predicted"),
                    F.lit(0).cast("long").alias("hits"),
                ),
            )
        ).alias("c")
    ).select("c.*")
    per_class = (
        cells.groupBy("class")
        .agg(F.sum("actual").alias("actual"), F.sum("predicted").alias("predicted"), F.sum("hits").alias("hits"))
        .withColumns(
            {
                "precision": F.coalesce(ratio("hits", "predicted"), F.lit(0.0)),
                "recall": F.coalesce(ratio("hits", "actual"), F.lit(0.0)),
            }
        )
        .withColumn(
            "f1",
            F.coalesce(
                F.lit(2.0) * F.col("precision") * F.col("recall")
                / F.nullif(F.col("precision") + F.col("recall"), F.lit(0.0)),
                F.lit(0.0),
            ),
        )
    )

    def weighted(c: str):
        return round_half_up(ratio(F.sum(F.col(c) * F.col("actual")), F.sum("actual")), digits)

    return per_class.agg(
        round_half_up(ratio(F.sum("hits"), F.sum("actual")), digits).alias("accuracy"),
        weighted("precision").alias("weighted_precision"),
        weighted("recall").alias("weighted_recall"),
        weighted("f1").alias("f1"),
    )


def auc_roc(df: DataFrame, score: str, positive: str, digits: int = 6) -> DataFrame:
    """Exact area under the ROC curve: the chance that a positive row outranks a negative one.

    Rows are counted per score first; equal scores count half.
    """
    counted = (
        df.where(F.col(score).isNotNull() & F.col(positive).isNotNull())
        .groupBy(F.col(score).alias("score"))
        .agg(F.count_if(F.col(positive)).alias("pos"), F.count_if(~F.col(positive)).alias("neg"))
    )
    placed = global_running_sum(counted, "score", ["neg"])
    wins = F.sum(F.col("pos") * (F.col("neg_before") * 2 + F.col("neg")))
    return placed.agg(
        round_half_up(ratio(wins.cast("double"), F.lit(2.0) * F.sum("pos") * F.sum("neg")), digits).alias("auc")
    )


def rmse(df: DataFrame, actual: str, predicted: str, digits: int = 6, rows: str | None = None) -> DataFrame:
    """Root mean squared error; rows without a prediction are left out.

    A row may stand for several: ``rows`` names the column with their number.
    """
    n = F.lit(1) if rows is None else F.col(rows)
    error = F.col(actual).cast("double") - F.col(predicted).cast("double")
    scored = df.where(~F.isnan(error) & error.isNotNull())
    return scored.agg(round_half_up(F.sqrt(ratio(F.sum(error * error * n), F.sum(n))), digits).alias("rmse"))


def evaluator_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> dict[str, float]:
    """The same four classification figures from Spark's own evaluator."""
    out = {}
    for name in ("accuracy", "weightedPrecision", "weightedRecall", "f1"):
        out[name] = MulticlassClassificationEvaluator(
            labelCol=label, predictionCol=prediction, metricName=name
        ).evaluate(df)
    return out


def evaluator_auc(df: DataFrame, label: str = "label", raw: str = "rawPrediction") -> float:
    return BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=raw).evaluate(df)


def evaluator_rmse(df: DataFrame, label: str, prediction: str = "prediction") -> float:
    return RegressionEvaluator(metricName="rmse", labelCol=label, predictionCol=prediction).evaluate(df)
