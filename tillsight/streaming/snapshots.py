"""Status questions on the current state of a stream result."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.ranking import top_rows

#: Rows that a status question shows; the newest periods of a current table with as many rows answer it.
CATEGORIES, BEHAVIOR, QUALITY = 5, 5, 3


def recent_categories(current: DataFrame, n: int = CATEGORIES) -> DataFrame:
    """Newest windows first, then the categories with the highest revenue."""
    return top_rows(current, [F.desc("window_start"), F.desc("total_revenue"), "category"], n).select(
        "window_start", "category", "transaction_count", "total_revenue", "avg_purchase"
    )


def recent_behavior(current: DataFrame, n: int = BEHAVIOR) -> DataFrame:
    """Newest windows first, then the largest customer groups."""
    return top_rows(
        current, [F.desc("window_start"), F.desc("customer_count"), "age_group", "gender"], n
    ).select("window_start", "age_group", "gender", "customer_count", "avg_spent", "premium_rate")


def recent_quality(current: DataFrame, n: int = QUALITY) -> DataFrame:
    """The newest quality windows."""
    return top_rows(current, [F.desc("window_start")], n).select(
        "window_start",
        "total_records",
        "age_null_count",
        "amount_null_count",
        "age_null_pct",
        "amount_null_pct",
        "avg_delay_sec",
    )
